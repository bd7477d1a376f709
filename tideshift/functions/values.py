"""Missing values, zero-safe division and timestamps as numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def nan_to_null(c: Column) -> Column:
    """One missing value only: NaN becomes NULL, so aggregates and fills skip it."""
    return F.nanvl(c, F.lit(None).cast("double"))


def clean_missing(df: DataFrame) -> DataFrame:
    """``nan_to_null`` on every floating column, applied where data enters."""
    floating = {
        f.name: nan_to_null(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floating) if floating else df


def divide(num: Column, den: Column) -> Column:
    """Floating division under ANSI rules: x/0 is signed infinity and 0/0 is missing."""
    infinity = F.lit(float("inf"))
    return (
        F.when((den == 0) & (num > 0), infinity)
        .when((den == 0) & (num < 0), -infinity)
        .otherwise(F.try_divide(num, den))
    )


def clip(c: Column, low: float, high: float) -> Column:
    """Clamp to ``[low, high]`` and keep missing values missing."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def micros(c: Column) -> Column:
    """Microseconds since the epoch, for both timestamp types."""
    return F.unix_micros(c.cast("timestamp"))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude
    ]
