"""Counts, errors and descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideshift.operators.runs import MAX_ROWS, join_keys, ordered_runs

QUARTILES = (0.25, 0.5, 0.75)


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    by: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Linearly interpolated percentiles per group and column, as ``p25``, ``p50`` and so on.

    Equal values are counted together first, and the running counts come from ordered runs, so a group
    that holds most of the rows is ranked by many tasks.
    """
    by = list(by)
    values = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = values.unpivot(by, list(columns), "column_name", "value").where(F.col("value").isNotNull())
    counts = long.groupBy(*by, "column_name", "value").agg(F.count(F.lit(1)).alias("__n"))
    runs = ordered_runs(counts, (*by, "column_name"), ("value",), max_rows)
    runs = runs.replace(runs.cumulative({"__n": "__upto"}))
    ranked = runs.whole({"__total": ("sum", "__n")})

    def at(index: Column) -> Column:
        inside = (F.col("__upto") - F.col("__n") <= index) & (index < F.col("__upto"))
        return F.max(F.when(inside, F.col("value")))

    ends, results = [], []
    for i, p in enumerate(probabilities):
        place = p * (F.col("__total") - 1)
        ends += [
            at(F.floor(place)).alias(f"__low_{i}"),
            at(F.ceil(place)).alias(f"__high_{i}"),
            F.max(place - F.floor(place)).alias(f"__share_{i}"),
        ]
        low, high, share = F.col(f"__low_{i}"), F.col(f"__high_{i}"), F.col(f"__share_{i}")
        results.append((low + (high - low) * share).alias(f"p{p * 100:g}"))
    return ranked.groupBy(*by, "column_name").agg(*ends).select(*by, "column_name", *results)


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per group and column."""
    by = list(by)
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy(*by).agg(
        *[f(F.col(c).cast("double")).alias(f"{c}__{m}") for c in columns for m, f in measures.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in columns
    ]
    moments = wide.select(*by, F.inline(F.array(*rows)))
    return join_keys(moments, exact_percentiles(df, columns, by=by, max_rows=max_rows), [*by, "column_name"], "left").select(
        *by, "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def distribution(df: DataFrame, column: str = "regime_id") -> DataFrame:
    """Rows and percent per value. The window runs over one row per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("percent", F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy()))


def group_means(df: DataFrame, columns: Sequence[str], by: str = "regime_id", digits: int = 2) -> DataFrame:
    """Means per group, rounded half to even."""
    return df.groupBy(by).agg(*[F.bround(F.avg(c), digits).alias(c) for c in columns])


def regression_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute and root mean squared error."""
    e = F.col(predicted) - F.col(actual)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse")
    )


def enough_samples(df: DataFrame, by: str = "regime_id", minimum: int = 50) -> DataFrame:
    """Groups with at least ``minimum`` complete rows."""
    counts = df.dropna("any").groupBy(by).agg(F.count(F.lit(1)).alias("n_samples"))
    return counts.where(F.col("n_samples") >= minimum)


def time_bounds(df: DataFrame, ts: str = "timestamp", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first_timestamp"), F.max(ts).alias("last_timestamp"))


def latest_row(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The last row of each series, by aggregation rather than by sorting."""
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
    return newest.select("__row.*")


def recent_rows(df: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows (of each series). Tasks keep only ``n`` rows per series before the shuffle.

    Spark does that for ranks up to a session setting, which is raised to ``n`` where it is lower.
    """
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(df.sparkSession.conf.get(setting)) < n:
        df.sparkSession.conf.set(setting, str(n))
    newest_first = [F.desc(c) for c in order]
    if not keys:
        return df.orderBy(*newest_first).limit(n)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("__place", place).where(F.col("__place") <= n).drop("__place")
