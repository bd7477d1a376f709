"""Gap filling and hourly spines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.functions.values import micros
from tideshift.operators.features import MEASURES
from tideshift.operators.runs import HALO, MAX_ROWS, join_keys, ordered_runs
from tideshift.session import shuffle_partitions

STEPS_PER_ROW = 4096


def forward_fill(
    df: DataFrame,
    limit: int = 2,
    columns: Sequence[str] = MEASURES,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Fill at most ``limit`` consecutive gaps with the last known value; 0 or less changes nothing."""
    present = [c for c in columns if c in df.columns]
    if limit <= 0 or not present:
        return df
    runs = ordered_runs(df, keys, (ts, *tie), max_rows).with_halo(limit)
    frame = runs.window.rowsBetween(-limit, 0)
    filled = runs.df.withColumns({c: F.last(c, True).over(frame) for c in present})
    return filled.where(~F.col(HALO)).select(*df.columns)


def spine(df: DataFrame, step_seconds: int = 3600, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Every timestamp from the first to the last of each series, ``step_seconds`` apart.

    The range is cut into pieces first and the pieces are spread out, so one long series is generated by
    many tasks and no array grows with it.
    """
    step = step_seconds * 1_000_000
    bounds = df.groupBy(*keys).agg(F.min(micros(F.col(ts))).alias("__a"), F.max(micros(F.col(ts))).alias("__b"))
    pieces = bounds.where(F.col("__a").isNotNull()).select(
        *keys,
        "__a",
        F.floor((F.col("__b") - F.col("__a")) / step).alias("__n"),
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor((F.col("__b") - F.col("__a")) / step), F.lit(STEPS_PER_ROW).cast("long"))
        ).alias("__i"),
    )
    spread = pieces.repartition(shuffle_partitions(df.sparkSession), *keys, "__i")
    last = F.least(F.col("__i") + STEPS_PER_ROW - 1, F.col("__n"))
    return spread.select(*keys, "__a", F.explode(F.sequence("__i", last)).alias("__i")).select(
        *keys, F.timestamp_micros(F.col("__a") + F.col("__i") * step).cast(df.schema[ts].dataType).alias(ts)
    )


def on_spine(df: DataFrame, step_seconds: int = 3600, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Rows put on the spine; steps without a row get missing measures.

    A missing key is a series of its own. Rows between the steps have no place on the spine and are left out.
    """
    return join_keys(spine(df, step_seconds, keys, ts), df, [*keys, ts], "left")
