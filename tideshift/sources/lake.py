"""The measurement lake (parquet by year, month and day), quarantine and feature sets."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PARTS = ("year", "month", "day")
LAYOUT = "_layout"  # hidden from readers of the lake


def write_lake(df: DataFrame, path: str, ts: str = "timestamp", run_end: datetime | None = None, mode: str = "append") -> None:
    """Write rows below ``year=/month=/day=``.

    Each row goes to the day of its own timestamp. With ``run_end`` the whole batch goes to that day,
    which is how a run-stamped lake is laid out; how far such a batch reaches to either side of that day is written
    beside the lake, so that ``read_lake`` looks into the right folders.
    """
    stamp = F.lit(run_end).cast("timestamp_ntz") if run_end else F.col(ts)
    dated = df.withColumns({"year": F.year(stamp), "month": F.month(stamp), "day": F.dayofmonth(stamp)})
    if run_end is None:
        # Adaptive execution splits a large day and merges small ones into files of the advisory size.
        dated = dated.hint("rebalance", *PARTS)
        dated.write.mode(mode).partitionBy(*PARTS).parquet(path)
        return
    seen = Observation()
    reach = dated.observe(seen, F.min(F.to_date(F.col(ts))).alias("first"), F.max(F.to_date(F.col(ts))).alias("last"))
    reach.write.mode(mode).partitionBy(*PARTS).parquet(path)
    first, last = seen.get["first"] or run_end.date(), seen.get["last"] or run_end.date()
    row = (max(0, (run_end.date() - first).days), max(0, (last - run_end.date()).days))
    spark = df.sparkSession
    spark.createDataFrame([row], "before int, after int").coalesce(1).write.mode("append").parquet(f"{path}/{LAYOUT}")


def lake_reach(spark: SparkSession, path: str) -> tuple[int, int]:
    """Days by which rows may lie before and after the day of their folder."""
    try:
        found = spark.read.parquet(f"{path}/{LAYOUT}").agg(F.max("before"), F.max("after")).collect()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, 0
    return found[0] or 0, found[1] or 0


def read_lake(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Lake rows of ``[start, end]``. Bounds prune day folders, widened by how far batches reach, and are pushed to the
    remaining files."""
    df = spark.read.parquet(path)
    day = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    before, ahead = lake_reach(spark, path)
    for bound, after in ((start, True), (end, False)):
        if bound is not None:
            folder = bound - timedelta(days=ahead) if after else bound + timedelta(days=before)
            limit = folder.year * 10_000 + folder.month * 100 + folder.day
            at = F.lit(bound).cast(df.schema[ts].dataType)
            df = df.where((day >= limit) & (F.col(ts) >= at) if after else (day <= limit) & (F.col(ts) <= at))
    return df


def latest_ingested(df: DataFrame, keys: Sequence[str], ts: str = "timestamp", stamp: str = "ingestion_timestamp") -> DataFrame:
    """One row per key and timestamp, the one ingested last: overlapping lookbacks repeat rows."""
    columns = [c for c in df.columns if c not in (*keys, ts)]
    newest = df.groupBy(*keys, ts).agg(F.max_by(F.struct(*columns), stamp).alias("__row"))
    return newest.select(*keys, ts, "__row.*").select(*df.columns)


def write_quarantine(
    df: DataFrame, path: str, start: datetime | None = None, end: datetime | None = None, reason: str = "reason"
) -> None:
    """Append rejected rows as JSON with the batch bounds, if any, one folder per reason."""
    quarantine_records(df, start, end, reason).write.mode("append").partitionBy("reason").json(path)


def quarantine_records(df: DataFrame, start: datetime | None, end: datetime | None, reason: str = "reason") -> DataFrame:
    def text(at: datetime | None) -> Column:
        return F.lit(at.isoformat() if at else None).cast("string")

    rest = [c for c in df.columns if c != reason]
    return df.select(
        text(start).alias("start_date"),
        text(end).alias("end_date"),
        F.col(reason).alias("reason"),
        F.to_json(F.struct(*rest)).alias("record"),
    )


# ---- feature sets -----------------------------------------------------------------------------


def save_features(
    df: DataFrame, store: str, version: str = "1.0.0", name: str = "energy_features", now: datetime | None = None
) -> str:
    """Write a feature set and its metadata row; returns the path of the set."""
    created = now or datetime.now(UTC).replace(tzinfo=None)
    path = f"{store}/data/{name}/v{version}/{created:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    spark = df.sparkSession
    written = spark.read.parquet(path)
    # Counted on the written files: their footers answer it.
    meta = written.agg(F.count(F.lit(1)).alias("n_samples")).select(
        F.lit(name).alias("feature_set_name"),
        F.lit(version).alias("version"),
        F.lit(created).cast("timestamp_ntz").alias("created_at"),
        "n_samples",
        F.lit(len(df.columns)).alias("n_features"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.lit(path).alias("path"),
    )
    meta.coalesce(1).write.mode("append").parquet(f"{store}/meta")
    return path


def feature_sets(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/meta")


def load_features(
    spark: SparkSession, store: str, version: str = "latest", name: str | None = None
) -> DataFrame | None:
    """The newest feature set, of the given version and name if one is asked for."""
    meta = feature_sets(spark, store)
    if version != "latest":
        meta = meta.where(F.col("version") == version)
    if name:
        meta = meta.where(F.col("feature_set_name") == name)
    path = meta.agg(F.max_by("path", "created_at").alias("path")).collect()[0]["path"]
    return spark.read.parquet(path) if path else None
