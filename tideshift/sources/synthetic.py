"""Synthetic hourly measurements."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideshift.functions.values import clip


def synthetic_series(spark: SparkSession, start: datetime, end: datetime, seed: int = 42) -> DataFrame:
    """Hourly wind, production, temperature and price from ``start`` to ``end`` inclusive.

    The noise depends on the seed and on how rows are split over tasks; the shape of the data does not.
    """
    hours = int((end - start).total_seconds() // 3600) + 1
    i = F.col("id")
    base = spark.range(hours).select(
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=i.cast("int"))).alias("timestamp"),
        "id",
        clip(6 + 2 * F.sin(i / 168) + F.randn(seed), 0.0, 20.0).alias("wind_speed"),
        F.randn(seed + 1).alias("n1"),
        F.randn(seed + 2).alias("n2"),
        F.randn(seed + 3).alias("n3"),
    )
    wind = F.col("wind_speed") / 20
    return base.select(
        "timestamp",
        "wind_speed",
        clip(100 + 500 * wind + 50 * F.col("n1"), 0.0, 1000.0).alias("energy_production"),
        (10 + 8 * F.sin(i / 24) + 3 * F.sin(i / 720) + F.col("n2")).alias("temperature"),
        clip(250 - 100 * wind + 50 * (1 + 0.3 * F.col("n3")), 50.0, 500.0).alias("price"),
    )
