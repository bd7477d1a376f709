"""Landed payload files to measurement rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.functions.values import clean_missing, numeric_columns

# Column names looked for when the configured one is absent, first match wins.
TIMESTAMP_NAMES = (
    "HourUTC", "HourDK", "Minutes5UTC", "Minutes5DK", "time", "TimeUTC", "TimeDK", "DateTime", "datetime",
)
PRICE_NAMES = ("SpotPrice", "SpotPriceEUR", "SpotPriceDKK", "ElspotPrice", "Price")
STANDARD_FIELDS = {name: name for name in ("wind_speed", "energy_production", "temperature", "price")}


class UnusablePayload(ValueError):
    """A payload without rows or without a timestamp column."""


def explode_records(df: DataFrame, record: T.StructType, payload: str = "payload") -> DataFrame:
    """Rows of each JSON text: its ``records``, else its ``data``, else the text itself as an array.

    A text of another shape gives no row; ``rejected_payloads`` returns those.
    """
    return df.select(*_others(df, payload), F.inline(_records(record, payload)))


def rejected_payloads(df: DataFrame, record: T.StructType, payload: str = "payload") -> DataFrame:
    return df.where(_records(record, payload).isNull())


def _records(record: T.StructType, payload: str) -> Column:
    rows = T.ArrayType(record)
    wrapped = F.from_json(payload, T.StructType([T.StructField("records", rows), T.StructField("data", rows)]))
    is_array = F.ltrim(payload).startswith("[")
    return F.when(is_array, F.from_json(payload, rows)).otherwise(F.coalesce(wrapped["records"], wrapped["data"]))


def _others(df: DataFrame, payload: str) -> list[str]:
    return [c for c in df.columns if c != payload]


def explode_weather(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows of texts that hold parallel arrays of times, temperatures and wind speeds."""
    doubles = T.ArrayType(T.DoubleType())
    hourly = T.StructType(
        [
            T.StructField("time", T.ArrayType(T.StringType())),
            T.StructField("temperature_2m", doubles),
            T.StructField("wind_speed_10m", doubles),
        ]
    )
    parsed = F.from_json(payload, T.StructType([T.StructField("hourly", hourly)]))["hourly"]
    zipped = F.arrays_zip(
        parsed["time"].alias("time"),
        parsed["temperature_2m"].alias("temperature"),
        parsed["wind_speed_10m"].alias("wind_speed"),
    )
    rows = df.select(*_others(df, payload), F.inline(zipped).alias("time", "temperature", "wind_speed"))
    return rows.select(
        *_others(df, payload), parse_timestamp(F.col("time")).alias("timestamp"), "temperature", "wind_speed"
    )


def parse_timestamp(c: Column, zone: str | None = None) -> Column:
    """Lenient parse: what is not a timestamp becomes missing. ``zone`` converts local times to UTC."""
    parsed = F.try_to_timestamp(c.cast("string"))
    return (F.to_utc_timestamp(parsed, zone) if zone else parsed).cast("timestamp_ntz")


def resolve_timestamp(df: DataFrame, configured: str = "timestamp", zone: str | None = None) -> DataFrame:
    """Rename the configured timestamp column, else the first known one, and parse it leniently."""
    found = next((c for c in (configured, *TIMESTAMP_NAMES) if c in df.columns), None)
    if found is None:
        raise UnusablePayload(f"no timestamp column '{configured}' among {df.columns}")
    named = df.withColumnRenamed(found, "timestamp")
    return named.withColumn("timestamp", parse_timestamp(F.col("timestamp"), zone))


def apply_field_map(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Rename source columns to standard ones; ``fields`` maps target to source."""
    return df.withColumnsRenamed({s: t for t, s in fields.items() if s in df.columns and s != t})


def name_price(df: DataFrame) -> DataFrame:
    """Without a ``price`` column, take the first known price name."""
    found = next((c for c in PRICE_NAMES if c in df.columns), None)
    return df if "price" in df.columns or found is None else df.withColumnRenamed(found, "price")


def name_production(df: DataFrame) -> DataFrame:
    """Without an ``energy_production`` column, take the first numeric one with 'production' in its name."""
    found = next((c for c in numeric_columns(df) if "production" in c.lower()), None)
    if "energy_production" in df.columns or found is None:
        return df
    return df.withColumnRenamed(found, "energy_production")


def mean_price(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One price per timestamp: the mean over price areas."""
    known = df.where(F.col("timestamp").isNotNull())
    return known.groupBy(*keys, "timestamp").agg(F.avg("price").alias("price"))


def total_production(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One production per timestamp: the sum over production types, 0 if all are missing."""
    known = df.where(F.col("timestamp").isNotNull())
    return known.groupBy(*keys, "timestamp").agg(
        F.coalesce(F.sum("energy_production"), F.lit(0.0)).alias("energy_production")
    )


def normalize(
    df: DataFrame,
    timestamp: str = "timestamp",
    fields: Mapping[str, str] = STANDARD_FIELDS,
    keys: Sequence[str] = (),
    zone: str | None = None,
) -> DataFrame:
    """Source rows to timestamp plus the mapped standard columns."""
    out = clean_missing(name_production(name_price(apply_field_map(resolve_timestamp(df, timestamp, zone), fields))))
    if "price" in out.columns and "PriceArea" in out.columns:
        out = mean_price(out, keys)
    if "energy_production" in out.columns and "ProductionType" in out.columns:
        out = total_production(out, keys)
    return out.select(*keys, "timestamp", *[c for c in fields if c in out.columns])


def read_payload_files(spark, path: str) -> DataFrame:
    """One row per landed file, its text in ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def high_watermark(df: DataFrame, ts: str = "timestamp", keys: Sequence[str] = ()) -> DataFrame:
    """Newest source timestamp, which ends the next batch."""
    return df.groupBy(*keys).agg(F.max(ts).alias("high_watermark"))


def ingest_window(
    df: DataFrame,
    end: datetime | None = None,
    start: datetime | None = None,
    lookback_hours: int = 24,
    ts: str = "timestamp",
) -> DataFrame:
    """Rows of ``[start, end]``, both inclusive. Without bounds the window ends at the newest row.

    The bounds are looked up first (one aggregate over one column), so they reach the scan as filters.
    """
    if end is None:
        end = high_watermark(df, ts).collect()[0]["high_watermark"]
        if end is None:
            return df.limit(0)
    kind = df.schema[ts].dataType.simpleString()
    last = F.lit(end).cast(kind)
    first = F.lit(start).cast(kind) if start else last - F.expr(f"INTERVAL {int(lookback_hours)} HOURS")
    return df.where((F.col(ts) >= first) & (F.col(ts) <= last))
