"""Distribution drift between a reference and a current set of rows, and alerts on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideshift.functions.kolmogorov import ks_p_value
from tideshift.functions.values import nan_to_null
from tideshift.operators.runs import MAX_ROWS, join_keys, ordered_runs
from tideshift.operators.summaries import recent_rows

# Watched measures, window sizes, thresholds and severity order.
WATCHED = ("wind_speed", "temperature", "price")
REFERENCE_ROWS = 1000
CURRENT_ROWS = 100
SEVERITY = {"low": 0, "medium": 1, "high": 2}
BINS = 50
SMOOTHING = 1e-10
SHIFT_EPSILON = 1e-8
MIN_VALUES = 10


@dataclass(frozen=True)
class Thresholds:
    ks_p: float = 0.05
    wasserstein: float = 0.3
    kl: float = 0.1
    chi2: float = 10.0
    chi2_high: float = 20.0


# ---- reference and current rows ---------------------------------------------------------------


def reference_rows(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), rows: int = REFERENCE_ROWS, minimum: int = CURRENT_ROWS
) -> DataFrame:
    """The newest ``rows`` rows of each series that has at least ``minimum`` rows."""
    newest = recent_rows(df, rows, order, keys)
    # At most `rows` rows per series are left, so counting them in a window is cheap.
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return newest.withColumn("__n", size).where(F.col("__n") >= minimum).drop("__n")


def current_rows(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), rows: int = CURRENT_ROWS) -> DataFrame:
    return recent_rows(df, rows, order, keys)


# ---- value distributions ----------------------------------------------------------------------


def _long(reference: DataFrame, current: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, is_reference: bool) -> DataFrame:
        wide = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
        return wide.unpivot(list(by), list(columns), "feature", "value").withColumn("__ref", F.lit(is_reference))

    return side(reference, True).unionByName(side(current, False)).where(F.col("value").isNotNull())


def _moments(long: DataFrame, group: Sequence[str]) -> DataFrame:
    ref, cur = F.when(F.col("__ref"), F.col("value")), F.when(~F.col("__ref"), F.col("value"))
    return long.groupBy(*group).agg(
        F.count(ref).alias("n_reference"),
        F.count(cur).alias("n_current"),
        F.avg(ref).alias("reference_mean"),
        F.avg(cur).alias("current_mean"),
        F.stddev_pop(ref).alias("reference_std"),
        F.stddev_pop(cur).alias("current_std"),
    )


def moment_shift(reference: DataFrame, current: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Means, deviations and their shift in percent of the reference."""
    return _with_shift(_moments(_long(reference, current, columns, by), [*by, "feature"]))


def _with_shift(moments: DataFrame) -> DataFrame:
    def shift(kind: str) -> Column:
        now, then = F.col(f"current_{kind}"), F.col(f"reference_{kind}")
        return F.abs(now - then) / (F.abs(then) + SHIFT_EPSILON) * 100

    return moments.withColumns({"mean_shift_pct": shift("mean"), "std_shift_pct": shift("std")})


def distances(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    bins: int = BINS,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """KS statistic, Wasserstein distance and KL divergence per feature."""
    return _distances(_long(reference, current, columns, by), [*by, "feature"], bins, max_rows)


def _distances(long: DataFrame, group: list[str], bins: int, max_rows: int | None) -> DataFrame:
    """All three from one ordered pass over the distinct values.

    Equal values are counted per side before anything is shuffled. Running counts give both
    distribution functions; their largest gap is KS and the area between them Wasserstein. The same
    rows fall into equal-width bins over the pooled range for KL; bins without any row add one common
    term each, so no bin table is joined.
    """
    counts = long.groupBy(*group, "value").agg(F.count_if("__ref").alias("__r"), F.count_if(~F.col("__ref")).alias("__c"))
    runs = ordered_runs(counts, group, ("value",), max_rows)
    runs = runs.replace(runs.last_known({"value": "__previous"}, strict=True))
    runs = runs.replace(runs.cumulative({"__r": "__upto_r", "__c": "__upto_c"}))
    rows = runs.whole(
        {"__all_r": ("sum", "__r"), "__all_c": ("sum", "__c"), "__low": ("min", "value"), "__high": ("max", "value")}
    )

    gap = F.abs(F.col("__upto_r") / F.col("__all_r") - F.col("__upto_c") / F.col("__all_c"))
    gap_before = F.abs(
        (F.col("__upto_r") - F.col("__r")) / F.col("__all_r") - (F.col("__upto_c") - F.col("__c")) / F.col("__all_c")
    )
    width = (F.col("__high") - F.col("__low")) / bins
    value, low = F.col("value"), F.col("__low")
    guess = F.least(F.floor((value - low) / F.when(width > 0, width)), F.lit(bins - 1))
    # The edges low + i * width decide, so a guess next to an edge is moved by one.
    placed = (
        F.when(guess.isNull(), bins - 1)
        .when(value < low + guess * width, guess - 1)
        .when((guess < bins - 1) & (value >= low + (guess + 1) * width), guess + 1)
        .otherwise(guess)
    )
    rows = rows.where((F.col("__all_r") > 0) & (F.col("__all_c") > 0))
    per_bin = rows.groupBy(*group, placed.alias("__bin")).agg(
        F.max(gap).alias("__ks"),
        F.sum(gap_before * (value - F.col("__previous"))).alias("__area"),
        F.sum("__r").alias("__r"),
        F.sum("__c").alias("__c"),
        F.first("__all_r").alias("__all_r"),
        F.first("__all_c").alias("__all_c"),
    )
    p = (F.col("__c") + SMOOTHING) / (F.col("__all_c") + SMOOTHING * bins)
    q = (F.col("__r") + SMOOTHING) / (F.col("__all_r") + SMOOTHING * bins)
    summed = per_bin.groupBy(*group).agg(
        F.max("__ks").alias("ks_statistic"),
        F.coalesce(F.sum("__area"), F.lit(0.0)).alias("wasserstein_distance"),
        F.sum(p * F.ln(p / q)).alias("__kl"),
        F.count(F.lit(1)).alias("__bins"),
        F.first("__all_r").alias("__all_r"),
        F.first("__all_c").alias("__all_c"),
    )
    empty_p = F.lit(SMOOTHING) / (F.col("__all_c") + SMOOTHING * bins)
    empty_q = F.lit(SMOOTHING) / (F.col("__all_r") + SMOOTHING * bins)
    return summed.select(
        *group,
        "ks_statistic",
        "wasserstein_distance",
        (F.col("__kl") + (bins - F.col("__bins")) * empty_p * F.ln(empty_p / empty_q)).alias("kl_divergence"),
    )


def severity(flags: Sequence[Column]) -> Column:
    """``high`` if two or more tests fail, ``medium`` for one, else ``low``; missing if a test without a verdict decides."""
    failed = reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(False)).cast("int") for f in flags])
    known = reduce(lambda a, b: a & b, [f.isNotNull() for f in flags])
    return F.when(failed >= 2, "high").when(known, F.when(failed == 1, "medium").otherwise("low"))


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] = WATCHED,
    by: Sequence[str] = (),
    thresholds: Thresholds = Thresholds(),
    p_value: str = "asymptotic",
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """One row per (series and) feature with all tests, their verdicts and the severity.

    With fewer than 10 values on a side there is no verdict and ``reason`` says so.
    """
    group = [*by, "feature"]
    long = _long(reference, current, columns, by)
    tests = join_keys(_with_shift(_moments(long, group)), _distances(long, group, BINS, max_rows), group, "left")
    enough = (F.col("n_reference") >= MIN_VALUES) & (F.col("n_current") >= MIN_VALUES)
    numbers = [c for c in tests.columns if c not in (*group, "n_reference", "n_current")]
    usable = tests.withColumns({c: F.when(enough, F.col(c)) for c in numbers}).withColumn(
        "ks_pvalue", ks_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current"), p_value)
    )
    judged = usable.withColumns(
        {
            "ks_drift": F.col("ks_pvalue") < thresholds.ks_p,
            "wasserstein_drift": F.col("wasserstein_distance") > thresholds.wasserstein,
            "kl_drift": F.col("kl_divergence") > thresholds.kl,
        }
    )
    flags = [F.col("ks_drift"), F.col("wasserstein_drift"), F.col("kl_drift")]
    verdict = severity(flags)
    return judged.withColumns(
        {
            "drift_detected": verdict != "low",
            "severity": F.when(enough, verdict),
            "reason": F.when(~enough, "insufficient_data"),
        }
    )


# ---- regimes ----------------------------------------------------------------------------------


def regime_drift(
    reference: DataFrame,
    current: DataFrame,
    regime: str = "regime_id",
    by: Sequence[str] = (),
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Chi-square distance of the regime shares, with both distributions as maps."""
    by = list(by)
    both = reference.select(*by, regime, F.lit(True).alias("__ref")).unionByName(
        current.select(*by, regime, F.lit(False).alias("__ref"))
    )
    counts = both.groupBy(*by, regime).agg(
        F.count_if("__ref").alias("__r"), F.count_if(~F.col("__ref")).alias("__c")
    )
    total = Window.partitionBy(*by)  # over one row per regime
    rows = counts.withColumns({"__all_r": F.sum("__r").over(total), "__all_c": F.sum("__c").over(total)}).where(
        (F.col("__all_r") > 0) & (F.col("__all_c") > 0)
    )
    expected = F.greatest(F.col("__r") * (F.col("__all_c") / F.col("__all_r")), F.lit(SMOOTHING))
    difference = F.col("__c") - expected

    def shares(n: str, total: str) -> Column:
        pairs = F.collect_list(F.when(F.col(n) > 0, F.struct(F.col(regime).cast("int"), F.col(n) / F.col(total))))
        return F.map_from_entries(F.array_sort(pairs))

    chi2 = F.col("chi2_statistic")
    return (
        rows.groupBy(*by)
        .agg(
            F.sum(difference * difference / expected).alias("chi2_statistic"),
            shares("__c", "__all_c").alias("current_distribution"),
            shares("__r", "__all_r").alias("reference_distribution"),
        )
        .withColumns(
            {
                "drift_detected": chi2 > thresholds.chi2,
                "severity": F.when(chi2 > thresholds.chi2_high, "high")
                .when(chi2 > thresholds.chi2, "medium")
                .otherwise("low"),
            }
        )
    )


# ---- report and alerts ------------------------------------------------------------------------


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] = WATCHED,
    prediction: str | None = "prediction",
    regime: str | None = "regime_id",
    by: Sequence[str] = (),
    thresholds: Thresholds = Thresholds(),
    p_value: str = "asymptotic",
    checked_at: datetime | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """The full check: a row per feature, one for predictions and one for regimes.

    Features and predictions go through the tests together, in one plan.
    """
    watched = [*columns, *([prediction] if prediction else [])]
    tested = feature_drift(reference, current, watched, by, thresholds, p_value, max_rows)
    is_prediction = F.col("feature") == prediction if prediction else F.lit(False)
    report = tested.withColumn("type", F.when(is_prediction, "prediction_drift").otherwise("feature_drift"))
    if regime:
        regimes = regime_drift(reference, current, regime, by, thresholds).withColumns(
            {"type": F.lit("regime_drift"), "feature": F.lit("regime")}
        )
        report = report.unionByName(regimes, allowMissingColumns=True)
    stamp = F.lit(checked_at) if checked_at else F.current_timestamp()
    return report.withColumn("checked_at", stamp.cast("timestamp_ntz"))


def alerts(report: DataFrame) -> DataFrame:
    return report.where(F.col("drift_detected")).withColumnRenamed("checked_at", "timestamp")


def refresh_reference(report: DataFrame) -> bool:
    """Whether a clean check allows taking the current rows as the new reference."""
    return report.where(F.col("drift_detected")).isEmpty()


def updated_reference(
    reference: DataFrame,
    current: DataFrame,
    report: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    rows: int = REFERENCE_ROWS,
    minimum: int = CURRENT_ROWS,
) -> DataFrame:
    """The reference for the next check: the newest current rows of each series whose check was clean, else the old rows.

    A series with fewer than ``minimum`` current rows, or without a report, keeps its reference.
    """
    by = list(by)
    if not by:
        clean = refresh_reference(report) and current.limit(minimum).count() >= minimum
        return recent_rows(current, rows, order) if clean else reference
    drifted = report.groupBy(*by).agg(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("__bad"))
    sizes = current.groupBy(*by).agg((F.count(F.lit(1)) >= minimum).alias("__enough"))
    clean = join_keys(drifted.where(~F.col("__bad")), sizes.where("__enough"), by, "inner").select(*by, F.lit(True).alias("__clean"))
    new = join_keys(recent_rows(current, rows, order, by), clean, by, "left").where("__clean").drop("__clean")
    old = join_keys(reference, clean, by, "left").where("__clean is null").drop("__clean")
    return new.unionByName(old.select(*new.columns))


def recent_alerts(alerts: DataFrame, hours: int = 24, now: datetime | None = None, ts: str = "timestamp") -> DataFrame:
    """Alerts strictly younger than ``hours``."""
    at = (F.lit(now) if now else F.current_timestamp()).cast("timestamp_ntz")
    return alerts.where(F.col(ts) > at - F.expr(f"INTERVAL {int(hours)} HOURS"))


def alert_gate(alerts: DataFrame, minimum: str = "medium", by: Sequence[str] = ()) -> DataFrame:
    """Whether any alert (of a group) reaches the severity. An unknown minimum counts as medium, an
    unknown severity as low; no alerts, no notice."""
    name = F.lower("severity")
    level = reduce(lambda w, item: w.when(name == item[0], item[1]), SEVERITY.items(), F).otherwise(0)
    needed = SEVERITY.get(minimum.lower(), 1)
    return alerts.groupBy(*by).agg(F.coalesce(F.max(level) >= needed, F.lit(False)).alias("send"))


def detector_status(
    observations: DataFrame,
    reference: DataFrame,
    recent: DataFrame,
    columns: Sequence[str] = WATCHED,
    prediction: str = "prediction",
    regime: str = "regime_id",
    rows: int = REFERENCE_ROWS,
) -> DataFrame:
    """Counts over the observation buffer, the reference and the recent alerts, as one row.

    A buffer holds at most ``rows`` observations.
    """
    def tagged(df: DataFrame, tag: str, *names: str) -> DataFrame:
        return df.select(F.lit(tag).alias("__tag"), *[F.col(c).isNotNull().alias(c) for c in names])

    # One table of presence flags, so the three inputs are counted in one aggregation.
    flags = (
        tagged(observations, "seen", *columns, prediction, regime)
        .unionByName(tagged(reference, "kept", *columns), allowMissingColumns=True)
        .unionByName(tagged(recent, "alert"), allowMissingColumns=True)
    )

    def count(tag: str, c: str) -> Column:
        return F.count_if((F.col("__tag") == tag) & F.col(c))

    def tracked(tag: str) -> Column:
        return reduce(lambda a, b: a + b, [(count(tag, c) > 0).cast("int") for c in columns])

    return flags.agg(
        (tracked("kept") > 0).alias("reference_distributions_set"),
        tracked("seen").alias("n_features_tracked"),
        tracked("kept").alias("n_reference_features"),
        F.least(count("seen", prediction), F.lit(rows)).cast("long").alias("prediction_samples"),
        F.least(count("seen", regime), F.lit(rows)).cast("long").alias("regime_samples"),
        F.count_if(F.col("__tag") == "alert").alias("recent_alerts_24h"),
    )


def last_report(reports: DataFrame, by: Sequence[str] = ("feature",), stamp: str = "checked_at") -> DataFrame:
    """The most recent report row of each feature."""
    newest = reports.groupBy(*by).agg(F.max_by(F.struct(*reports.columns), stamp).alias("__row"))
    return newest.select("__row.*")
