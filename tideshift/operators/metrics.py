"""Counters, histograms and rates from the prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Histogram bounds.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
STAGE_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
CONFIDENCE_BUCKETS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0)
VALUE_BUCKETS = (0.0, 50.0, 100.0, 150.0, 200.0, 250.0, 300.0, 400.0, 500.0, 750.0, 1000.0)
INFINITY = float("inf")


def counter(df: DataFrame, labels: Sequence[str], name: str = "total") -> DataFrame:
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias(name))


def histogram(
    df: DataFrame, value: str, buckets: Sequence[float], labels: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Cumulative buckets per label set, rows ``(labels, le, count)``, the last with infinite bound.

    All buckets are conditional counts of one aggregation; only its few result rows are unfolded.
    """
    known = df.where(F.col(value).isNotNull() if where is None else where & F.col(value).isNotNull())
    counted = known.groupBy(*labels).agg(
        *[F.count_if(F.col(value) <= float(b)).alias(f"__b{i}") for i, b in enumerate(buckets)],
        F.count(F.lit(1)).alias("__all"),
    )
    bounds = [(float(b), f"__b{i}") for i, b in enumerate(buckets)] + [(INFINITY, "__all")]
    rows = F.array(*[F.struct(F.lit(b).alias("le"), F.col(c).alias("count")) for b, c in bounds])
    return counted.select(*labels, F.inline(rows))


def histogram_sums(df: DataFrame, value: str, labels: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Sum and count next to the buckets of ``histogram``."""
    known = df.where(where) if where is not None else df
    return known.groupBy(*labels).agg(F.sum(value).alias("sum"), F.count(value).alias("count"))


def histogram_quantile(buckets: DataFrame, q: float, labels: Sequence[str] = ()) -> DataFrame:
    """Quantile from cumulative buckets, linear inside a bucket.

    The lowest bucket starts at 0; a quantile in the infinite bucket gives the highest finite bound.
    Works on bucket rows only, of which there are a few per label set.
    """
    w = Window.partitionBy(*labels).orderBy("le")
    rows = buckets.withColumns(
        {
            "__before": F.coalesce(F.lag("count").over(w), F.lit(0)),
            "__from": F.lag("le").over(w),
            "__rank": q * F.max("count").over(Window.partitionBy(*labels)),
        }
    )
    hit = (F.col("count") >= F.col("__rank")) & (F.col("__before") < F.col("__rank"))
    inside = (F.col("__rank") - F.col("__before")) / (F.col("count") - F.col("__before"))
    start = F.coalesce("__from", F.when(F.col("le") > 0, F.lit(0.0)).otherwise(F.col("le")))
    value = F.when(F.col("le") == INFINITY, F.col("__from")).otherwise(start + (F.col("le") - start) * inside)
    return rows.where(hit).select(*labels, F.lit(q).alias("quantile"), value.alias("value"))


def windowed_quantile(
    df: DataFrame, value: str, buckets: Sequence[float], q: float, ts: str = "timestamp", minutes: int = 5, every_minutes: int = 1
) -> DataFrame:
    """Quantile per sliding window from its buckets, over all other labels. Buckets are counted per step first."""
    step = f"{every_minutes} minutes"
    counts = histogram(df.withColumn("__step", F.window(ts, step)["start"]), value, buckets, ["__step"])
    w = F.window("__step", f"{minutes} minutes", step)
    summed = counts.groupBy(w.alias("__w"), "le").agg(F.sum("count").alias("count"))
    flat = summed.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), "le", "count")
    return histogram_quantile(flat, q, ["window_start", "window_end"])


def batch_counter(log: DataFrame, batch: Sequence[str], status: str = "status") -> DataFrame:
    """Scored batches by outcome: all requests answered, some, or none."""
    good = F.col(status) == "success"
    outcome = F.when(F.bool_and(good), "success").when(F.bool_or(good), "partial").otherwise("error")
    return counter(log.groupBy(*batch).agg(outcome.alias("outcome")), ["outcome"], "batches")


def sliding_rate(
    df: DataFrame, labels: Sequence[str], ts: str = "timestamp", minutes: int = 5, every_minutes: int = 1
) -> DataFrame:
    """Events per second over sliding windows. Rows are counted per step first, and only the counts are
    repeated for the windows a step belongs to."""
    step = f"{every_minutes} minutes"
    counts = df.groupBy(*labels, F.window(ts, step).alias("__step")).agg(F.count(F.lit(1)).alias("__n"))
    flat = counts.select(*labels, F.col("__step.start").alias("__at"), "__n")
    sliding = flat.groupBy(*labels, F.window("__at", f"{minutes} minutes", step).alias("__w"))
    return sliding.agg((F.sum("__n") / F.lit(minutes * 60.0)).alias("rate")).select(
        *labels, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), "rate"
    )


def error_counts(df: DataFrame, error: str = "error_type") -> DataFrame:
    """Rows per error type."""
    return counter(df.where(F.col(error).isNotNull()), [error], "errors")


def batch_failures(batches: DataFrame, failed: str = "n_failed") -> DataFrame:
    """Failed items of scored batches as an error count; batches without failures add nothing."""
    total = batches.agg(F.coalesce(F.sum(failed), F.lit(0)).alias("errors")).where(F.col("errors") > 0)
    return total.select(F.lit("batch_item_failed").alias("error_type"), "errors")


def models_loaded(models: DataFrame) -> DataFrame:
    """Gauge: number of models in use, with their names by regime as text."""
    entry = F.concat(F.lit("regime_"), F.col("regime_id"), F.lit(":"), F.col("model_name"))
    return models.agg(
        F.count(F.lit(1)).alias("models_loaded"), F.concat_ws(",", F.array_sort(F.collect_set(entry))).alias("models")
    )
