"""Measure-like views over the given tables, in DataFrame form and as SQL text.

Measures are kept in quarter units and built from integers, so that sums over a window are exact in
double precision and both engines round the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("long")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series: activity per hour of the events table."""
    events = table(spark, sf_dir, "events")
    active = F.when(F.col("event_type").isin("click", "view"), 1).otherwise(0)
    n = F.count(F.lit(1))
    return events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")).agg(
        (F.floor(F.sum(active) * 120 / n) / 4).alias("wind_speed"),
        (F.floor(F.sum(_cents("value")) * 4 / (n * 10)) / 4).alias("energy_production"),
        (F.floor(F.min(_cents("value")) / 25) / 4).alias("temperature"),
        (F.floor(F.max(_cents("value")) / 25) / 4).alias("price"),
    )


HOURLY = """
SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp,
       floor(sum(CASE WHEN event_type IN ('click','view') THEN 1 ELSE 0 END) * 120 / count(*)) / 4e0 AS wind_speed,
       floor(sum(CAST(round(value * 100) AS BIGINT)) * 4 / (count(*) * 10)) / 4e0 AS energy_production,
       floor(min(CAST(round(value * 100) AS BIGINT)) / 25) / 4e0 AS temperature,
       floor(max(CAST(round(value * 100) AS BIGINT)) / 25) / 4e0 AS price
FROM events GROUP BY 1"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event, with values in and out of the accepted ranges."""
    return to_points(table(spark, sf_dir, "events"))


def to_points(events: DataFrame) -> DataFrame:
    value = F.col("value")
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").alias("timestamp"),
        "event_type",
        ((_cents("value") % 3500) / 100).alias("wind_speed"),
        (value * 10).alias("energy_production"),
        (value - 45).alias("temperature"),
        (value * 2).alias("price"),
    )


POINTS = """
SELECT event_id, user_id, ts AS timestamp, event_type,
       (CAST(round(value * 100) AS BIGINT) % 3500) / 1e2 AS wind_speed,
       value * 1e1 AS energy_production, value - 45e0 AS temperature, value * 2e0 AS price
FROM events"""


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many series: one row per supplier and shipping day. Days without shipment are missing."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("series"), F.col("l_shipdate").alias("timestamp"))
        .agg(
            F.sum(F.round(F.col("l_discount") * 100)).alias("wind_speed"),
            F.sum("l_quantity").alias("energy_production"),
            F.sum(F.round(F.col("l_tax") * 100)).alias("temperature"),
            (F.floor(F.sum(_cents("l_extendedprice")) / 25000) / 4).alias("price"),
        )
    )


KEYED = """
SELECT l_suppkey AS series, l_shipdate AS timestamp,
       sum(round(l_discount * 100)) AS wind_speed, sum(l_quantity) AS energy_production,
       sum(round(l_tax * 100)) AS temperature,
       floor(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 25000) / 4e0 AS price
FROM lineitem GROUP BY 1, 2"""

REGIME_CASE = "CASE WHEN wind_speed > 10 THEN 0 WHEN wind_speed > 5 THEN 1 ELSE 2 END"

# One prediction-log row per request; `error` marks requests outside the accepted ranges.
LOG = f"""
SELECT event_id, user_id, timestamp, event_type, regime_id,
       CASE regime_id WHEN 0 THEN 'volatile' WHEN 1 THEN 'neutral' ELSE 'stable' END AS regime_name,
       CASE regime_id WHEN 0 THEN 87e-2 WHEN 1 THEN 82e-2 ELSE 78e-2 END AS confidence,
       'mock' AS model_name, 'mock' AS model_type,
       energy_production * 105e-2 AS prediction,
       (energy_production / 1e1) / 1e2 AS latency_s,
       CASE WHEN wind_speed BETWEEN 0 AND 30 AND energy_production BETWEEN 0 AND 1000
             AND temperature BETWEEN -40 AND 50 AND price BETWEEN 0 AND 500 THEN 'success' ELSE 'error' END AS status
FROM (SELECT *, {REGIME_CASE} AS regime_id FROM points)"""


def with_views(body: str, *names: str) -> str:
    """Prefix a query with the views it uses, in the order given."""
    known = {"hourly": HOURLY, "points": POINTS, "keyed": KEYED, "log": LOG}
    ctes = ", ".join(f"{n} AS ({known[n]})" for n in names)
    return f"WITH {ctes}{', ' if body.lstrip().startswith('+') else ' '}{body.lstrip().removeprefix('+')}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, as SQL's round does: in binary arithmetic, halves away from zero.

    NaN becomes missing and infinity stays. Rounding the decimal form of a double would differ where the sixth digit
    is followed by a 5: -0.5046875 times a million is 504687.49999999994.
    """
    scale = F.lit(float(10**digits))
    columns = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double":
            c = F.col(f.name)
            # Adding 0 turns a negative zero into a plain one. Values too large to be scaled stay as they are.
            scaled = F.nanvl(c, F.lit(None)) * scale
            value = F.when(F.abs(scaled) == float("inf"), c).otherwise(F.round(scaled) / scale + 0.0)
            columns.append(value.alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def sql_round(expression: str, name: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return (
        f"CASE WHEN isinf({expression}) THEN {expression} WHEN isnan({expression}) THEN NULL "
        f"ELSE round({expression}, {digits}) + 0e0 END AS {name}"
    )
