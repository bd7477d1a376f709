"""Prediction log and structured log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideshift.functions.values import micros

INPUT_SHARE = 0.05
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_text(c: Column) -> Column:
    """ISO text with microseconds."""
    return F.date_format(c, TIME_FORMAT)


def with_correlation_id(df: DataFrame, column: str = "correlation_id") -> DataFrame:
    """Keep an incoming correlation id, else make one. Make ids once and store them: they are random."""
    given = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(given, F.uuid()))


def hash_share(columns: Sequence[str], share: float, seed: int = 42) -> Column:
    """A repeatable draw: true for about ``share`` of the distinct values of ``columns``.

    The first 32 bits of a digest, as hexadecimal text, are compared with the share of their range. A
    recomputed task draws the same rows again, which a random number generator would not promise.
    """
    if share >= 1:
        return F.lit(True)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed)))
    return F.substring(F.md5(text), 1, 8) < f"{int(share * 2**32):08x}"


def prediction_log(
    scored: DataFrame,
    inputs: Sequence[str] = (),
    id_columns: Sequence[str] = ("correlation_id",),
    share: float = INPUT_SHARE,
) -> DataFrame:
    """Log rows of scored requests; a share of them keeps the input measures."""
    logged = ("regime_id", "regime_name", "model_name", "prediction", "confidence", "latency_ms")
    columns = [c for c in (*id_columns, "timestamp", *logged) if c in scored.columns]
    sample = F.when(hash_share(id_columns, share), F.struct(*inputs)) if inputs else None
    return scored.select(*columns, *([sample.alias("input_sample")] if inputs else []))


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def log_lines(
    df: DataFrame,
    logger: str,
    message: Column,
    level: Column,
    ts: str = "timestamp",
    correlation: Column | None = None,
    extra: Sequence[str] = (),
    error_type: Column | None = None,
    error_message: Column | None = None,
) -> DataFrame:
    """One JSON text per row, in ``line``; missing extras are left out, an error becomes an object."""
    fields = [
        iso_text(F.col(ts)).alias("timestamp"),
        level.alias("level"),
        F.lit(logger).alias("logger"),
        message.alias("message"),
    ]
    if correlation is not None:
        fields.append(correlation.alias("correlation_id"))
    fields += [F.col(c) for c in extra]
    if error_type is not None:
        error = F.struct(error_type.alias("type"), error_message.alias("message"))
        fields.append(F.when(error_type.isNotNull(), error).alias("error"))
    return df.select(F.to_json(F.struct(*fields)).alias("line"))


def read_log_lines(lines: DataFrame, schema: str, column: str = "line") -> DataFrame:
    return lines.select(F.from_json(column, schema).alias("__line")).select("__line.*")


def completion_lines(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Log lines of finished requests: INFO below status 400, WARNING from 400, ERROR with an error."""
    failed = F.col("error_type").isNotNull()
    bad = F.col("status_code") >= 400
    return log_lines(
        df,
        "request",
        F.when(failed, "Request failed").when(bad, "Request completed with error").otherwise("Request completed"),
        F.when(failed, "ERROR").when(bad, "WARNING").otherwise("INFO"),
        ts,
        F.col("correlation_id"),
        ("status_code", "duration_ms"),
        F.col("error_type"),
        F.col("error_message"),
    )


def operation_durations(
    log: DataFrame, by: Sequence[str] = ("correlation_id", "operation"), ts: str = "timestamp", phase: str = "phase"
) -> DataFrame:
    """Milliseconds between the start and end row of each operation; unfinished ones are left out.

    Starts and ends meet in one grouping instead of a self-join. A restarted timer counts from its
    latest start, as a running timer would.
    """
    at = F.col(ts)
    paired = log.groupBy(*by).agg(
        F.max(F.when(F.col(phase) == "start", at)).alias("started_at"),
        F.max(F.when(F.col(phase) == "end", at)).alias("ended_at"),
    )
    return paired.where(F.col("ended_at") >= F.col("started_at")).withColumn(
        "duration_ms", (micros(F.col("ended_at")) - micros(F.col("started_at"))) / 1000
    )


def custom_metric(df: DataFrame, name: Column, value: Column, tags: dict[str, Column] | None = None) -> DataFrame:
    """Metric records: name, value and tags as a map."""
    parts = [x for k, v in (tags or {}).items() for x in (F.lit(k), v.cast("string"))]
    tag_map = F.create_map(*parts) if parts else F.lit(None).cast("map<string,string>")
    return df.select(name.alias("metric_name"), value.cast("double").alias("value"), tag_map.alias("tags"))
