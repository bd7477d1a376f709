"""Routing rows to regime models, scoring and batch results."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.operators.regimes import regime_name, rule_regime
from tideshift.operators.validation import check_ranges
from tideshift.sources.logs import hash_share
from tideshift.sources.payloads import parse_timestamp

# Factor and noise of the stand-in prediction, its model name, the tracked share.
FALLBACK_FACTOR = 1.05
FALLBACK_NOISE = 10.0
FALLBACK_MODEL = "mock"
TRACKED_SHARE = 0.01


def default_timestamp(df: DataFrame, column: str = "timestamp", now=None) -> DataFrame:
    """Parse the timestamp text; a missing or unusable one becomes ``now`` (the time of the run)."""
    fallback = F.lit(now) if now is not None else F.current_timestamp()
    parsed = F.coalesce(parse_timestamp(F.col(column)), fallback.cast("timestamp_ntz"))
    return df.withColumn(column, parsed)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values and NaN to 0."""
    zero = F.lit(0.0)
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), zero), zero) for c in columns})


def point_posterior(
    df: DataFrame,
    columns: Sequence[str],
    start: Sequence[float],
    means: Sequence[Sequence[float]],
    variances: Sequence[Sequence[float]],
) -> DataFrame:
    """Regime probabilities of rows taken alone: start weight times Gaussian density, normalised.

    Adds ``regime_proba_k``, the most likely ``regime_id`` (the first on ties) and its ``confidence``. The
    parameters are literals, so this is a projection without shuffle.
    """
    n = len(start)
    logs = {}
    for k in range(n):
        scale = math.log(start[k]) if start[k] > 0 else float("-inf")
        scale -= 0.5 * sum(math.log(2 * math.pi * v) for v in variances[k])
        terms = [
            (F.col(c) - float(m)) * (F.col(c) - float(m)) / float(v)
            for c, m, v in zip(columns, means[k], variances[k])
        ]
        logs[f"__log_{k}"] = F.lit(scale) - reduce(lambda a, b: a + b, terms) * 0.5
    best = F.greatest(*[F.col(f"__log_{k}") for k in range(n)]) if n > 1 else F.col("__log_0")
    weights = {f"__w_{k}": F.exp(F.col(f"__log_{k}") - F.col("__best")) for k in range(n)}
    total = reduce(lambda a, b: a + b, [F.col(w) for w in weights])
    regime = reduce(lambda w, k: w.when(F.col(f"__log_{k}") == F.col("__best"), k), range(n), F)
    return (
        df.withColumns(logs)
        .withColumn("__best", best)
        .withColumns(weights)
        .select(
            *df.columns,
            *[(F.col(f"__w_{k}") / total).alias(f"regime_proba_{k}") for k in range(n)],
            regime.alias("regime_id"),
            (1 / total).alias("confidence"),
        )
    )


def fallback_prediction(df: DataFrame, energy: str = "energy_production", noise_seed: int | None = None) -> DataFrame:
    """The stand-in prediction for regimes without a model; noise only with a seed."""
    prediction = F.col(energy) * FALLBACK_FACTOR
    if noise_seed is not None:
        prediction = prediction + F.randn(noise_seed) * FALLBACK_NOISE
    return df.withColumns({"prediction": prediction, "model_name": F.lit(FALLBACK_MODEL)})


def route(df: DataFrame, names: Mapping[int, str], regime: str = "regime_id") -> DataFrame:
    """Name of the model each row goes to; a literal lookup, as there are only a few regimes."""
    chosen = reduce(lambda w, item: w.when(F.col(regime) == item[0], item[1]), names.items(), F)
    return df.withColumn("model_name", chosen.otherwise(FALLBACK_MODEL) if names else F.lit(FALLBACK_MODEL))


def score_routed(df: DataFrame, models: Mapping[int, object], names: Mapping[int, str], regime: str = "regime_id") -> DataFrame:
    """Score each row with the model of its regime, the others with the stand-in prediction.

    ``models`` are fitted transformers that add ``prediction``.
    """
    parts = []
    for k, model in models.items():
        scored = model.transform(df.where(F.col(regime) == k))
        parts.append(scored.select(*df.columns, "prediction").withColumn("model_name", F.lit(names[k])))
    known = F.col(regime).isin(list(models)) if models else F.lit(False)
    parts.append(fallback_prediction(df.where(~F.coalesce(known, F.lit(False)))))
    return reduce(DataFrame.unionByName, parts)


def score_batch(df: DataFrame, noise_seed: int | None = None) -> DataFrame:
    """Score a batch by rule and stand-in prediction; rejected rows stay with status ``error``.

    One projection: no row is dropped and nothing is shuffled.
    """
    scored = fallback_prediction(rule_regime(check_ranges(df)), noise_seed=noise_seed)
    good = F.col("reason").isNull()
    results = ("regime_id", "confidence", "regime_name", "prediction", "model_name")
    return scored.withColumns({c: F.when(good, F.col(c)) for c in results}).withColumn(
        "status", F.when(good, "success").otherwise("error")
    )


def batch_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    success = F.col("status") == "success"
    return scored.groupBy(*by).agg(F.count_if(success).alias("n_succeeded"), F.count_if(~success).alias("n_failed"))


def tracked_sample(df: DataFrame, columns: Sequence[str], share: float = TRACKED_SHARE, seed: int = 42) -> DataFrame:
    """A repeatable sample of scored rows for the run log."""
    return df.where(hash_share(columns, share, seed))


def responses(scored: DataFrame, version: str = "1.0.0") -> DataFrame:
    """Scored rows in response form."""
    return scored.withColumns({"unit": F.lit("MWh"), "model_version": F.lit(version)}).withColumn(
        "regime", F.coalesce("regime_name", regime_name(F.col("regime_id"), "unknown"))
    )
