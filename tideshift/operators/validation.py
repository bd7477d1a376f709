"""Batch and row checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideshift.operators.features import MEASURES

# Required columns, the share of missing values that is reported, accepted ranges.
REQUIRED = ("timestamp", *MEASURES)
NULL_SHARE = 0.1
RANGES = {
    "wind_speed": (0.0, 30.0),
    "energy_production": (0.0, 1000.0),
    "temperature": (-40.0, 50.0),
    "price": (0.0, 500.0),
}


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> list[str]:
    """Required columns the table lacks, in order. Reads the schema only."""
    return [c for c in required if c not in df.columns]


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = NULL_SHARE) -> DataFrame:
    """Share of missing values per column, all columns in one pass."""
    names = list(columns or df.columns)
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    return shares.unpivot([], names, "column_name", "null_ratio").withColumn(
        "above_threshold", F.col("null_ratio") > threshold
    )


def duplicate_timestamps(df: DataFrame, ts: str = "timestamp", keys: Sequence[str] = ()) -> DataFrame:
    """Rows that repeat a timestamp (of their series); a missing timestamp counts as one value.

    Grouping by the timestamp first keeps distinct values out of any single task.
    """
    counts = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*keys).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def validate_batch(
    df: DataFrame,
    required: Sequence[str] = REQUIRED,
    null_threshold: float = NULL_SHARE,
    fail_on_nulls: bool = False,
) -> tuple[bool, DataFrame | None]:
    """Whether the batch passes, and its null report. Only missing columns fail it unless asked."""
    if missing_columns(df, required):
        return False, None
    report = null_ratios(df, threshold=null_threshold)
    if fail_on_nulls and not report.where("above_threshold").isEmpty():
        return False, report
    return True, report


def out_of_range(ranges: Mapping[str, tuple[float, float]] = RANGES) -> Column:
    """Name of the first measure that is missing or out of range; missing if the row is fine."""
    broken = None
    for c, (low, high) in ranges.items():
        bad = F.col(c).isNull() | ~F.col(c).between(F.lit(low), F.lit(high))
        broken = F.when(bad, c) if broken is None else broken.when(bad, c)
    return broken


def check_ranges(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = RANGES, ts: str | None = None
) -> DataFrame:
    """Rows plus ``reason``, missing for valid rows. With ``ts`` a missing timestamp is a reason too."""
    reason = out_of_range(ranges)
    return df.withColumn("reason", F.when(F.col(ts).isNull(), ts).otherwise(reason) if ts else reason)


def split_valid(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] = RANGES, ts: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with a reason."""
    checked = check_ranges(df, ranges, ts)
    return checked.where(F.col("reason").isNull()).drop("reason"), checked.where(F.col("reason").isNotNull())


def stamp_batch(df: DataFrame, source: str) -> DataFrame:
    """Add when and from where the rows came."""
    return df.withColumns({"ingestion_timestamp": F.current_timestamp(), "data_source": F.lit(source)})
