"""Run records and model versions as append-only tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideshift.operators.runs import MAX_ROWS, RUN, join_keys, ordered_runs

RUN_SCHEMA = (
    "run_id string, run_name string, logged_at timestamp_ntz, tags map<string,string>, "
    "params map<string,string>, metrics map<string,double>"
)


def run_record(
    spark: SparkSession,
    regime_id: int,
    model_name: str,
    model_type: str,
    metrics: Mapping[str, float],
    params: Mapping[str, object],
    n_samples: int,
    logged_at: datetime | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """One training run as a row."""
    tags = {
        "regime_id": str(regime_id),
        "model_name": model_name,
        "model_type": model_type,
        "training_stage": "regime_model",
    }
    logged = {k: str(v) for k, v in {**params, "n_samples": n_samples, "regime_id": regime_id}.items()}
    row = (
        run_id or uuid.uuid4().hex,
        f"regime_{regime_id}_{model_name}",
        logged_at or datetime.now(UTC).replace(tzinfo=None),
        tags,
        logged,
        {k: float(v) for k, v in metrics.items()},
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def inference_records(sample: DataFrame, logged_at: datetime | None = None) -> DataFrame:
    """Sampled scored rows as run records."""
    at = (F.lit(logged_at) if logged_at else F.current_timestamp()).cast("timestamp_ntz")
    return sample.select(
        F.uuid().alias("run_id"),
        F.lit("inference").alias("run_name"),
        at.alias("logged_at"),
        F.create_map(
            F.lit("regime_id"), F.col("regime_id").cast("string"), F.lit("model_name"), F.col("model_name"),
            F.lit("inference_stage"), F.lit("production"),
        ).alias("tags"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.create_map(
            F.lit("prediction"), F.col("prediction"), F.lit("regime_confidence"), F.col("confidence"),
        ).alias("metrics"),
    )


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def assign_versions(
    registrations: DataFrame,
    existing: DataFrame | None = None,
    order: Sequence[str] = ("registered_at",),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Number new registrations of each name after its existing versions."""
    numbered = ordered_runs(registrations, ("name",), order, max_rows).numbered("version").drop(RUN)
    if existing is None:
        return numbered
    newest = existing.groupBy("name").agg(F.max("version").alias("__newest"))
    shifted = F.coalesce("__newest", F.lit(0)) + F.col("version")
    return join_keys(numbered, newest, ["name"], "left").withColumn("version", shifted).drop("__newest")


def latest_versions(versions: DataFrame) -> DataFrame:
    """The newest version of each name and stage; older ones stay in the table."""
    rest = [c for c in versions.columns if c not in ("name", "stage")]
    newest = versions.groupBy("name", "stage").agg(F.max_by(F.struct(*rest), "version").alias("__row"))
    return newest.select("name", "stage", "__row.*")


def list_models(versions: DataFrame) -> DataFrame:
    """Names with their latest version per stage, as a list of structs (one per stage)."""
    latest = latest_versions(versions)
    entry = F.struct("version", "stage", *[c for c in ("status", "run_id") if c in latest.columns])
    return latest.groupBy("name").agg(F.array_sort(F.collect_list(entry)).alias("latest_versions"))


def pick_models(versions: DataFrame, names: Mapping[int, str], stage: str = "Production") -> DataFrame:
    """The version each regime would load: the newest of its registered name in the stage."""
    regime = _by_name(names)
    wanted = versions.where((F.col("stage") == stage) & F.col("name").isin(list(names.values())))
    return latest_versions(wanted).withColumn("regime_id", regime)


def _by_name(names: Mapping[int, str]) -> Column:
    pairs = [F.lit(x) for k, n in names.items() for x in (n, k)]
    return F.create_map(*pairs)[F.col("name")]


def effective_models(local: Mapping[int, str], picked: DataFrame) -> dict[int, str]:
    """Local model names by regime, overridden by the registry's. A few rows at most."""
    return {**local, **{r["regime_id"]: f"{r['name']}/{r['version']}" for r in picked.collect()}}

