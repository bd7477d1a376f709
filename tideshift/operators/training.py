"""One regressor per regime: split, fit, errors, storage and run records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.functions.values import micros
from tideshift.operators.neural import NeuralRegressor, fit_neural
from tideshift.operators.registry import append_runs, run_record
from tideshift.operators.summaries import regression_errors
from tideshift.session import settle
from tideshift.sources.logs import hash_share

# Model per regime and model settings.
MODEL_BY_REGIME = {0: "boosted_trees", 1: "neural", 2: "random_forest"}
SEED = 42
TEST_SHARE = 0.2
MIN_SAMPLES = 50
TASK_ROWS = 250_000  # rows of a task of a tree fit, which keeps and reads them again and again


@dataclass(frozen=True)
class Settings:
    tree_depth: int = 6
    learning_rate: float = 0.1
    rounds: int = 100
    forest_trees: int = 100
    forest_depth: int = 15
    epochs: int = 50
    test_share: float = TEST_SHARE
    seed: int = SEED


@dataclass(frozen=True)
class Trained:
    models: dict[int, object] = field(default_factory=dict)
    names: dict[int, str] = field(default_factory=dict)
    results: list[tuple] = field(default_factory=list)


def split_rows(df: DataFrame, identity: Sequence[str], test_share: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Random training and test rows, drawn by the identity of a row."""
    test = hash_share(identity, test_share, seed)
    return df.where(~test), df.where(test)


def split_by_time(df: DataFrame, ts: str = "timestamp", test_share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """Training rows before, test rows from the timestamp that leaves about ``test_share`` behind it."""
    at = df.agg(F.percentile_approx(micros(F.col(ts)), 1 - test_share, 100_000)).collect()[0][0]
    late = micros(F.col(ts)) > F.lit(at)
    return df.where(~late), df.where(late)


def _assembled(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def fit_boosted_trees(train: DataFrame, columns: Sequence[str], target: str, s: Settings = Settings()):
    trees = GBTRegressor(
        labelCol=target, maxDepth=s.tree_depth, stepSize=s.learning_rate, maxIter=s.rounds, seed=s.seed, lossType="squared"
    )
    return _fit_trees(trees, train, columns)


def fit_random_forest(train: DataFrame, columns: Sequence[str], target: str, s: Settings = Settings()):
    trees = RandomForestRegressor(
        labelCol=target, numTrees=s.forest_trees, maxDepth=s.forest_depth, featureSubsetStrategy="all", seed=s.seed
    )
    return _fit_trees(trees, train, columns)


def _fit_trees(estimator, train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    assembler = _assembled(columns)
    # Stored rows are packed far denser than the fit keeps them, so a part of a file may hold too many for a task.
    rows = train.select(*dict.fromkeys([*columns, estimator.getLabelCol()]))
    parts = -(-rows.count() // TASK_ROWS)
    if rows.rdd.getNumPartitions() < parts:
        rows = rows.repartition(parts)
    return PipelineModel([assembler, estimator.fit(assembler.transform(rows))])


def fit_network(train: DataFrame, columns: Sequence[str], target: str, s: Settings = Settings()):
    # Stored anew: the draw of the training rows hashes their identity, which each epoch would do again.
    return fit_neural(train, columns, target, epochs=s.epochs, seed=s.seed)


FITTERS: dict[str, Callable] = {
    "boosted_trees": fit_boosted_trees,
    "neural": fit_network,
    "random_forest": fit_random_forest,
}


def model_settings(name: str, s: Settings) -> dict[str, object]:
    own = {
        "boosted_trees": {"max_depth": s.tree_depth, "learning_rate": s.learning_rate, "n_estimators": s.rounds},
        "random_forest": {"n_estimators": s.forest_trees, "max_depth": s.forest_depth},
        "neural": {"epochs": s.epochs},
    }
    return {"model_name": name, "test_size": s.test_share, "random_state": s.seed, **own.get(name, {})}


def train_regimes(
    df: DataFrame,
    columns: Sequence[str],
    identity: Sequence[str],
    target: str = "energy_production",
    regime: str = "regime_id",
    minimum: int = MIN_SAMPLES,
    model_by_regime: Mapping[int, str] = MODEL_BY_REGIME,
    settings: Settings = Settings(),
    split: str = "random",
    ts: str = "timestamp",
    path: str | None = None,
    runs_path: str | None = None,
    stored: bool = False,
) -> Trained:
    """Fit, test and store a model for each regime with enough complete rows.

    There are a handful of regimes; each fit is itself distributed. Unknown model names get a forest. ``stored`` says
    that the rows are stored by regime already.
    """
    if regime not in df.columns:
        raise ValueError(f"rows need a '{regime}' column")
    # Infinite rates of change cannot enter a model; such rows are left out and counted.
    finite = [F.abs(F.col(c).cast("double")) != float("inf") for c in columns]
    complete = df.dropna("any").withColumn("__finite", reduce(and_, finite))
    needed = dict.fromkeys([*identity, ts, *columns, target, regime])
    # Computed once and stored by regime: every fit passes over its rows many times.
    usable = complete.select(*needed, "__finite")
    usable = usable if stored else settle(usable, by=(regime,))
    counts = usable.groupBy(regime).agg(F.count_if("__finite").alias("n"), F.count_if(~F.col("__finite")).alias("out")).collect()
    sizes, left_out = {r[regime]: r["n"] for r in counts}, {r[regime]: r["out"] for r in counts}
    trained = Trained()
    for k in sorted(sizes):
        if sizes[k] < minimum:
            continue
        rows = usable.where((F.col(regime) == k) & F.col("__finite")).drop(regime, "__finite")
        train, test = (
            split_by_time(rows, ts, settings.test_share)
            if split == "temporal"
            else split_rows(rows, identity, settings.test_share, settings.seed)
        )
        name = model_by_regime.get(k, model_by_regime[max(model_by_regime)])
        model = FITTERS.get(name, fit_random_forest)(train, columns, target, settings)
        e = regression_errors(model.transform(test), target, "prediction").collect()[0]
        stored = None
        if path:
            stored = f"{path}/regime_{k}_{name}"
            save_regressor(df.sparkSession, model, stored)
        trained.models[k], trained.names[k] = model, name
        trained.results.append((int(k), name, int(sizes[k]), int(left_out[k]), e["mae"], e["rmse"], stored))
        if runs_path:
            metrics = {"mae": e["mae"] or 0.0, "rmse": e["rmse"] or 0.0}
            kind = "network" if name == "neural" else "trees"
            append_runs(
                run_record(df.sparkSession, int(k), name, kind, metrics, model_settings(name, settings), sizes[k]), runs_path
            )
    return trained


def result_table(spark, trained: Trained) -> DataFrame:
    """One row per trained regime; ``n_left_out`` rows had infinite features."""
    return spark.createDataFrame(
        trained.results, "regime_id int, model_name string, n_samples long, n_left_out long, mae double, rmse double, model_path string"
    )


def save_regressor(spark, model, path: str) -> None:
    """Trees in Spark's own format, networks as one parquet row."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        return
    row = (list(model.columns), model.weights.tolist(), list(model.hidden), model.centre.tolist(), model.scale.tolist())
    schema = "columns array<string>, weights array<double>, hidden array<int>, centre array<double>, scale array<double>"
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_regressor(spark, path: str, name: str):
    if name != "neural":
        return PipelineModel.load(path)
    r = spark.read.parquet(path).collect()[0]
    return NeuralRegressor(
        tuple(r["columns"]), np.array(r["weights"]), tuple(r["hidden"]), np.array(r["centre"]), np.array(r["scale"])
    )
