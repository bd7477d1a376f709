"""Regime labels: rules, change-point segments, transitions and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideshift.operators.runs import HALO, MAX_ROWS, join_keys, ordered_runs
from tideshift.operators.summaries import describe

# Regime names, and the rule used where no detector is available.
REGIME_NAMES = {0: "volatile", 1: "neutral", 2: "stable"}
RULE = ((10.0, 0, 0.87), (5.0, 1, 0.82))
RULE_ELSE = (2, 0.78)


def regime_name(regime: Column, unknown: str | None = None) -> Column:
    """Name of a regime id; an unlisted id gives ``unknown``, which is missing by default."""
    out = reduce(lambda w, item: w.when(regime == item[0], item[1]), REGIME_NAMES.items(), F)
    return out.otherwise(F.lit(unknown).cast("string"))


def rule_regime(df: DataFrame, wind: str = "wind_speed") -> DataFrame:
    """Regime, confidence and name by wind speed alone."""
    w = F.col(wind)
    regime, confidence = F, F
    for above, label, certainty in RULE:
        regime, confidence = regime.when(w > above, label), confidence.when(w > above, certainty)
    out = df.withColumns(
        {"regime_id": regime.otherwise(RULE_ELSE[0]), "confidence": confidence.otherwise(RULE_ELSE[1])}
    )
    return out.withColumn("regime_name", regime_name(F.col("regime_id"), "unknown"))


def transitions(
    df: DataFrame,
    regime: str = "regime_id",
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Rows whose regime differs from the row before; the first row of a series is none."""
    runs = ordered_runs(df.select(*keys, ts, *tie, regime), keys, (ts, *tie), max_rows).with_halo(1)
    seen = runs.df.withColumn("from_regime", F.lag(regime).over(runs.window)).where(~F.col(HALO))
    changed = seen.where(F.col("from_regime").isNotNull() & (F.col("from_regime") != F.col(regime)))
    return changed.select(
        *keys,
        ts,
        "from_regime",
        F.col(regime).alias("to_regime"),
        regime_name(F.col("from_regime")).alias("from_regime_name"),
        regime_name(F.col(regime)).alias("to_regime_name"),
    )


def regime_profile(
    df: DataFrame,
    columns: Sequence[str],
    regime: str = "regime_id",
    ts: str = "timestamp",
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Per regime and column: rows, first and last timestamp and descriptive statistics."""
    extent = df.groupBy(regime).agg(
        F.count(F.lit(1)).alias("n_samples"), F.min(ts).alias("start"), F.max(ts).alias("end")
    )
    named = extent.withColumn(
        "regime_name", F.coalesce(regime_name(F.col(regime)), F.concat(F.lit("regime_"), F.col(regime)))
    )
    return join_keys(describe(df, columns, [regime], max_rows), named, [regime], "inner")


def relabel_by_volatility(df: DataFrame, column: str, regime: str = "regime_id") -> DataFrame:
    """Rename regimes so that 0 is the one with the largest deviation of ``column``."""
    spread = df.groupBy(regime).agg(F.stddev_pop(column).alias("__std"))
    # One row per regime: the ranking and its broadcast are as small as the number of regimes.
    order = spread.select(
        regime, (F.row_number().over(Window.orderBy(F.desc("__std"), regime)) - 1).cast("int").alias("__new")
    )
    return join_keys(df, F.broadcast(order), [regime], "inner").withColumn(regime, F.col("__new")).drop("__new")


# ---- segments between change points -----------------------------------------------------------


def assign_segments(
    df: DataFrame,
    breakpoints: DataFrame,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp",),
    end: str = "segment_end",
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Rows plus ``position`` (from 0), ``segment`` (from 0) and ``n_segments`` of their series.

    ``breakpoints`` holds exclusive end positions, one row each. A row's segment is the number of ends at
    or before it: ends are laid out between the rows and counted, so rows and ends never form pairs. Rows
    behind the last end get segment ``n_segments``. Repeated ends make empty segments and count once.
    """
    keys = list(keys)
    numbered = ordered_runs(df, keys, order, max_rows).numbered("__place")
    rows = numbered.select(
        *keys, (F.col("__place") - 1).alias("position"), F.lit(1).alias("__side"), F.struct(*df.columns).alias("__row")
    ).withColumn("__end", F.lit(0).cast("long"))
    ends = (
        breakpoints.select(*keys, F.col(end).cast("long").alias("position"))
        .where(F.col("position") > 0)
        .distinct()
        .withColumns({"__side": F.lit(0), "__end": F.lit(1).cast("long")})
    )
    both = rows.unionByName(ends, allowMissingColumns=True)
    runs = ordered_runs(both, keys, ("position", "__side"), max_rows)
    runs = runs.replace(runs.cumulative({"__end": "segment"}))
    counted = runs.whole({"n_segments": ("sum", "__end")}).where(F.col("__side") == 1)
    return counted.select("__row.*", "position", "segment", "n_segments")


def segment_volatility(segmented: DataFrame, signal: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, bounds and population deviation of each segment; rows behind the last end belong to none."""
    return (
        segmented.where(F.col("segment") < F.col("n_segments"))
        .groupBy(*keys, "segment")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("position").alias("segment_start"),
            (F.max("position") + 1).alias("segment_end"),
            F.stddev_pop(signal).alias("volatility"),
        )
    )


def segment_regimes(
    volatility: DataFrame, n_regimes: int = 3, keys: Sequence[str] = (), max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """Segments with a regime by rank of deviation: the calmest get ``n_regimes - 1``, the wildest 0."""
    runs = ordered_runs(volatility, keys, ("volatility", "segment"), max_rows)
    ranked = runs.numbered("__rank", total="__count")
    share = (F.col("__rank") - 1) / F.greatest(F.col("__count") - 1, F.lit(1))
    bucket = F.bround(share * (n_regimes - 1), 0).cast("int")
    regime = F.lit(1) if n_regimes == 1 else F.lit(n_regimes - 1) - bucket
    return ranked.select(*volatility.columns, regime.alias("regime_id"))


def label_segments(
    df: DataFrame,
    breakpoints: DataFrame,
    signal: str,
    n_regimes: int = 3,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp",),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Rows plus the regime of their segment; rows behind the last end get 0.

    Also labels new data with stored ends.
    """
    segmented = assign_segments(df, breakpoints, keys, order, max_rows=max_rows)
    labels = segment_regimes(segment_volatility(segmented, signal, keys), n_regimes, keys, max_rows)
    joined = join_keys(segmented, labels.select(*keys, "segment", "regime_id"), [*keys, "segment"], "left")
    return joined.select(
        *df.columns, "position", "segment", F.coalesce("regime_id", F.lit(0)).alias("regime_id")
    )


def one_hot(df: DataFrame, regime: str = "regime_id", n_regimes: int = 3) -> DataFrame:
    """Certain probabilities for labels without a model."""
    return df.withColumns(
        {f"regime_proba_{k}": F.when(F.col(regime) == k, 1.0).otherwise(0.0) for k in range(n_regimes)}
    )
