"""Prediction log, metric tables, drift tests and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.operators import drift, metrics, scoring
from tideshift.operators.regimes import rule_regime
from tideshift.operators.validation import out_of_range
from tideshift.plans.views import points, rounded, sql_round, table, with_views
from tideshift.session import scratch_path
from tideshift.sources import logs

HALF = datetime(2024, 1, 16)
CHECKED = datetime(2024, 1, 31, 12)


def prediction_log(spark, sf) -> DataFrame:
    """Every request scored by rule, also those outside the accepted ranges, with status and latency."""
    return to_log(points(spark, sf))


def to_log(requests: DataFrame) -> DataFrame:
    scored = scoring.fallback_prediction(rule_regime(requests))
    return scored.select(
        "event_id", "user_id", "timestamp", "event_type", "regime_id", "regime_name", "confidence", "model_name",
        F.lit("mock").alias("model_type"), "prediction",
        (F.col("energy_production") / 10 / 100).alias("latency_s"),
        F.when(out_of_range().isNull(), "success").otherwise("error").alias("status"),
    )


def _success():
    return F.col("status") == "success"


def _halves(df: DataFrame):
    return df.where(F.col("timestamp") < HALF), df.where(F.col("timestamp") >= HALF)


def _watched(spark, sf) -> DataFrame:
    """Scored requests with the watched measures."""
    return scoring.fallback_prediction(rule_regime(points(spark, sf)))


def distances(spark, sf) -> DataFrame:
    return drift.distances(*_halves(points(spark, sf)), drift.WATCHED)


def distances_by_type(spark, sf) -> DataFrame:
    return drift.distances(*_halves(points(spark, sf)), drift.WATCHED, by=["event_type"])


def report(spark, sf) -> DataFrame:
    """First half of the period against the second, with the limit p-value."""
    return drift.drift_report(*_halves(_watched(spark, sf)), checked_at=CHECKED)


REPORT_COLUMNS = (
    "type", "feature", "drift_detected", "severity", "ks_statistic", "ks_drift", "wasserstein_distance",
    "wasserstein_drift", "kl_divergence", "kl_drift", "mean_shift_pct", "std_shift_pct", "chi2_statistic",
)


def _flags_as_numbers(df: DataFrame) -> DataFrame:
    """Verdicts are missing where a test does not apply; 0, 1 and missing compare alike everywhere."""
    return df.withColumns({c: F.col(c).cast("int") for c in ("ks_drift", "wasserstein_drift", "kl_drift")})


def report_table(spark, sf) -> DataFrame:
    return rounded(_flags_as_numbers(report(spark, sf).select(*REPORT_COLUMNS)), 9)


def recent_report(spark, sf) -> DataFrame:
    """The running check: newest 1000 rows of each type of event against its newest 100."""
    rows, order, by = _watched(spark, sf), ["timestamp", "event_id"], ["event_type"]
    reference = drift.reference_rows(rows, order, by)
    current = drift.current_rows(rows, order, by)
    found = drift.drift_report(reference, current, by=by, checked_at=CHECKED)
    return rounded(_flags_as_numbers(found.select("event_type", *REPORT_COLUMNS, "ks_pvalue")))


def regime_chi2(spark, sf) -> DataFrame:
    found = drift.regime_drift(*_halves(_watched(spark, sf)), by=["event_type"])
    maps = ("current_distribution", "reference_distribution")
    return rounded(
        found.select(
            "event_type", "chi2_statistic", "drift_detected", "severity",
            *[F.col(m)[k].alias(f"{m[:3]}_{k}") for m in maps for k in range(3)],
        )
    )


def daily_alerts(spark, sf) -> DataFrame:
    """An alert row per user and day, its severity by the highest price of the day."""
    day = F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("timestamp")
    top = points(spark, sf).groupBy("user_id", day).agg(F.max("price").alias("price"))
    level = F.when(F.col("price") > 300, "HIGH").when(F.col("price") > 150, "medium").when(F.col("price") > 80, "low")
    return top.select("user_id", "timestamp", F.coalesce(level, F.lit("notice")).alias("severity"))


def status(spark, sf) -> DataFrame:
    rows, order = _watched(spark, sf), ["timestamp", "event_id"]
    recent = drift.recent_alerts(daily_alerts(spark, sf), 24 * 5, datetime(2024, 1, 31))
    return drift.detector_status(rows, drift.reference_rows(rows, order), recent)


def last_check(spark, sf) -> DataFrame:
    """Two checks with different stamps, the later one wins per feature."""
    early = drift.moment_shift(*_halves(points(spark, sf)), drift.WATCHED).withColumn("checked_at", F.lit(HALF))
    late = drift.moment_shift(*reversed(_halves(points(spark, sf))), drift.WATCHED).withColumn("checked_at", F.lit(CHECKED))
    both = early.unionByName(late).withColumn("checked_at", F.col("checked_at").cast("timestamp_ntz"))
    return rounded(drift.last_report(both))


def log_roundtrip(spark, sf) -> DataFrame:
    """The log as written: fixed columns, and the inputs kept for a share of the rows."""
    path = scratch_path(spark, "log")
    scored = _watched(spark, sf).withColumn("latency_ms", F.col("energy_production"))
    log = logs.prediction_log(scored, ["wind_speed", "price"], ["event_id"])
    logs.append_log(log, path)
    return rounded(spark.read.parquet(path).drop("input_sample"))


def log_lines(spark, sf) -> DataFrame:
    """Completion lines written as JSON text and read back."""
    rows = prediction_log(spark, sf).select(
        "event_id", "timestamp", F.col("user_id").cast("string").alias("correlation_id"),
        F.when(F.col("status") == "error", 422).otherwise(200).alias("status_code"),
        F.col("latency_s").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "ValueError").alias("error_type"),
        F.when(F.col("event_type") == "error", F.lit('bad "input"')).alias("error_message"),
    )
    parsed = logs.read_log_lines(
        logs.completion_lines(rows),
        "timestamp string, level string, logger string, message string, correlation_id string, status_code int, "
        "duration_ms double, error struct<type string, message string>",
    )
    return rounded(
        parsed.select("*", F.col("error.type").alias("error_type"), F.col("error.message").alias("error_message")).drop("error")
    )


def durations(spark, sf) -> DataFrame:
    """Each line item starts with its order and ends with its shipment."""
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("correlation_id"), F.col("l_linenumber").alias("operation"),
        F.lit("end").alias("phase"), F.col("l_shipdate").alias("timestamp"),
    )
    begun = table(spark, sf, "orders").select(F.col("o_orderkey").alias("correlation_id"), F.col("o_orderdate").alias("timestamp"))
    starts = items.select("correlation_id", "operation").distinct().join(begun, "correlation_id").select(
        "correlation_id", "operation", F.lit("start").alias("phase"), "timestamp"
    )
    return logs.operation_durations(items.unionByName(starts))


def latency_histogram(spark, sf) -> DataFrame:
    return metrics.histogram(
        prediction_log(spark, sf), "latency_s", metrics.LATENCY_BUCKETS, ["regime_name", "model_name"], _success()
    )


def correlated(spark, sf) -> DataFrame:
    """Incoming ids are kept, missing ones are made and differ."""
    given = F.when(F.col("event_type") != "view", F.concat(F.lit("req-"), F.col("event_id")))
    made = logs.with_correlation_id(points(spark, sf).withColumn("correlation_id", given))
    return made.groupBy("event_type").agg(
        F.count_if(F.col("correlation_id").startswith("req-")).alias("kept"),
        F.count_if(F.length("correlation_id") == 36).alias("made"),
    )


def custom_metrics(spark, sf) -> DataFrame:
    made = logs.custom_metric(
        prediction_log(spark, sf), F.col("event_type"), F.col("latency_s"), {"regime": F.col("regime_name")}
    )
    return rounded(
        made.groupBy("metric_name", F.col("tags")["regime"].alias("regime")).agg(
            F.count("value").alias("n"), F.max("value").alias("largest")
        )
    )


def error_table(spark, sf) -> DataFrame:
    """Errors by type, with the failed items of scored batches (one per user) added."""
    log = prediction_log(spark, sf).withColumn("error_type", F.when(~_success(), F.col("event_type")))
    batches = scoring.batch_counts(log, ["user_id"])
    return metrics.error_counts(log).unionByName(metrics.batch_failures(batches))


QUERIES = {
    "prediction_log": log_roundtrip,
    "json_log_lines": log_lines,
    "correlation_ids": correlated,
    "op_duration": durations,
    "metric_custom": custom_metrics,
    "metric_requests": lambda s, d: metrics.counter(prediction_log(s, d), ["regime_name", "model_name", "status"]),
    "metric_latency_hist": latency_histogram,
    "metric_stage_hist": lambda s, d: metrics.histogram(prediction_log(s, d), "latency_s", metrics.STAGE_BUCKETS),
    "metric_regimes": lambda s, d: metrics.counter(prediction_log(s, d), ["regime_id", "regime_name"]),
    "metric_confidence_hist": lambda s, d: metrics.histogram(
        prediction_log(s, d), "confidence", metrics.CONFIDENCE_BUCKETS, ["regime_name"]
    ),
    "metric_model_usage": lambda s, d: metrics.counter(prediction_log(s, d), ["regime_id", "model_name", "model_type"]),
    "metric_value_hist": lambda s, d: metrics.histogram(
        prediction_log(s, d), "prediction", metrics.VALUE_BUCKETS, where=_success()
    ),
    "metric_errors": error_table,
    "rate_5m": lambda s, d: rounded(metrics.sliding_rate(prediction_log(s, d), ["status"])),
    "rate_5m_regime": lambda s, d: rounded(metrics.sliding_rate(prediction_log(s, d), ["regime_name"])),
    "hist_quantile": lambda s, d: rounded(
        metrics.histogram_quantile(latency_histogram(s, d), 0.95, ["regime_name", "model_name"])
    ),
    "ks_stat": lambda s, d: rounded(distances(s, d).select("feature", "ks_statistic"), 9),
    "wasserstein": lambda s, d: rounded(distances(s, d).select("feature", "wasserstein_distance"), 9),
    "kl_divergence": lambda s, d: rounded(distances(s, d).select("feature", "kl_divergence"), 9),
    "drift_distances_keyed": lambda s, d: rounded(distances_by_type(s, d), 9),
    "moment_shift": lambda s, d: rounded(drift.moment_shift(*_halves(points(s, d)), drift.WATCHED)),
    "regime_chi2": regime_chi2,
    "drift_severity": lambda s, d: report(s, d).select("feature", "severity", "drift_detected"),
    "drift_report": report_table,
    "drift_report_recent": recent_report,
    "drift_reference": lambda s, d: rounded(
        drift.reference_rows(points(s, d), ["timestamp", "event_id"], ["user_id"], 1000, 60)
    ),
    "recent_alerts": lambda s, d: drift.recent_alerts(daily_alerts(s, d), 24 * 5, datetime(2024, 1, 31)),
    "alert_gate": lambda s, d: drift.alert_gate(daily_alerts(s, d), "HIGH", ["user_id"]),
    "drift_status": status,
    "drift_last": last_check,
}


# ---- SQL --------------------------------------------------------------------------------------


def _log_sql(body: str) -> str:
    return with_views(body, "points", "log")


def _hist_sql(value: str, buckets, labels: str = "", where: str = "true") -> str:
    bounds = ", ".join([*[f"{b:e}" for b in buckets], "'inf'::DOUBLE"])
    by = f"{labels}, " if labels else ""
    groups = f"GROUP BY {labels}, le" if labels else "GROUP BY le"
    return (
        f"SELECT {by}le, count(*) FILTER ({value} <= le) AS \"count\" "
        f"FROM log, (SELECT unnest([{bounds}]) AS le) WHERE {where} {groups}"
    )


def _long_sql(columns, extra: str = "", source: str = "points", split: str = "timestamp < TIMESTAMP '2024-01-16'") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra} '{c}' AS feature, {c} AS value, {split} AS ref FROM {source}" for c in columns
    )


def _tests_sql(columns, by: str = "", source: str = "points") -> str:
    """Common tables: long values, moments, distances from running counts and bins between listed edges."""
    g = f"{by}, feature" if by else "feature"
    same = " AND ".join(f"{{a}}.{k} = {{b}}.{k}" for k in g.split(", "))
    return f"""
      long AS ({_long_sql(columns, f'{by},' if by else '', source)}),
      mom AS (SELECT {g}, count(*) FILTER (ref) AS nr, count(*) FILTER (NOT ref) AS nc, avg(value) FILTER (ref) AS mr,
        avg(value) FILTER (NOT ref) AS mc, stddev_pop(value) FILTER (ref) AS sr, stddev_pop(value) FILTER (NOT ref) AS sc,
        min(value) AS lo, max(value) AS hi FROM long GROUP BY {g}),
      vals AS (SELECT {g}, value, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM long GROUP BY {g}, value),
      cdf AS (SELECT *, sum(r) OVER w / sum(r) OVER p AS f, sum(c) OVER w / sum(c) OVER p AS gg, lead(value) OVER w AS nxt FROM vals
        WINDOW w AS (PARTITION BY {g} ORDER BY value), p AS (PARTITION BY {g})),
      dist AS (SELECT {g}, max(abs(f - gg)) AS ks, coalesce(sum(abs(f - gg) * (nxt - value)), 0e0) AS ws FROM cdf GROUP BY {g}),
      edges AS (SELECT {g}, i, nr, nc, lo + i * ((hi - lo) / 50) AS a,
        CASE WHEN i = 49 THEN 'inf'::DOUBLE ELSE lo + (i + 1) * ((hi - lo) / 50) END AS b FROM mom, range(50) t(i)),
      binned AS (SELECT {', '.join(f'e.{k}' for k in g.split(', '))}, e.i, any_value(nr) AS nr, any_value(nc) AS nc, coalesce(sum(v.r), 0) AS r, coalesce(sum(v.c), 0) AS c
        FROM edges e LEFT JOIN vals v ON {same.format(a='e', b='v')} AND v.value >= e.a AND v.value < e.b GROUP BY {', '.join(f'e.{k}' for k in g.split(', '))}, e.i),
      kl AS (SELECT {g}, sum((c + 1e-10) / (nc + 5e-9) * ln(((c + 1e-10) / (nc + 5e-9)) / ((r + 1e-10) / (nr + 5e-9)))) AS kl
        FROM binned GROUP BY {g})"""


_SCORED = "scored AS (SELECT *, energy_production * 105e-2 AS prediction, CASE WHEN wind_speed > 10 THEN 0 WHEN wind_speed > 5 THEN 1 ELSE 2 END AS regime_id FROM points)"
_WATCHED = ("wind_speed", "temperature", "price")
_MOMENT_COLUMNS = f"""nr AS n_reference, nc AS n_current, {sql_round('mr', 'reference_mean')}, {sql_round('mc', 'current_mean')},
  {sql_round('sr', 'reference_std')}, {sql_round('sc', 'current_std')},
  {sql_round('abs(mc - mr) / (abs(mr) + 1e-8) * 100', 'mean_shift_pct')}, {sql_round('abs(sc - sr) / (abs(sr) + 1e-8) * 100', 'std_shift_pct')}"""


def _chi_sql(by: str) -> str:
    g = f"{by}, " if by else ""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return f"""
      cnt AS (SELECT {g}regime_id, count(*) FILTER (timestamp < TIMESTAMP '2024-01-16') AS r, count(*) FILTER (timestamp >= TIMESTAMP '2024-01-16') AS c
              FROM scored GROUP BY {g}regime_id),
      tot AS (SELECT *, sum(r) {over} AS tr, sum(c) {over} AS tc FROM cnt),
      ex AS (SELECT *, greatest(r * (tc / tr), 1e-10) AS e FROM tot),
      chi AS (SELECT {g}sum((c - e) * (c - e) / e) AS chi2, {', '.join(f'max(CASE WHEN regime_id = {k} AND c > 0 THEN c / tc END) AS cur_{k}, max(CASE WHEN regime_id = {k} AND r > 0 THEN r / tr END) AS ref_{k}' for k in range(3))}
              FROM ex {f'GROUP BY {by}' if by else ''})"""


_KOLMOGOROV = "greatest(0e0, least(1e0, list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END) * exp(-2e0 * k * k * z2)))))"
_HALVES = "timestamp < TIMESTAMP '2024-01-16'"


def _report_sql(by: str = "", rows: str = "", ref: str = _HALVES) -> str:
    """Common tables up to ``rep``, the whole report. ``rows`` defines a table ``sides`` from ``scored``; ``ref`` tells its sides."""
    source, g = ("sides" if rows else "scored"), (f"{by}, " if by else "")
    tests = _tests_sql((*_WATCHED, "prediction"), by, source=source).replace(_HALVES, ref)
    chi = _chi_sql(by).replace(_HALVES, ref).replace("timestamp >= TIMESTAMP '2024-01-16'", f"NOT ({ref})").replace("FROM scored", f"FROM {source}")
    using = f"USING ({g}feature)"
    return f"""{_SCORED}, {rows}{', ' if rows else ''}{tests}, {chi},
  j AS (SELECT mom.*, ks, ws, kl, ks * ks * nr * nc / (nr + nc) AS z2 FROM mom JOIN dist {using} JOIN kl {using}),
  p AS (SELECT *, CASE WHEN z2 < 4e-2 THEN 1e0 ELSE {_KOLMOGOROV} END AS pv FROM j),
  t AS (SELECT *, pv < 5e-2 AS kd, ws > 3e-1 AS wd, kl > 1e-1 AS ld FROM p),
  s AS (SELECT *, CAST(kd AS INT) + CAST(wd AS INT) + CAST(ld AS INT) AS failed FROM t),
  rep AS (SELECT {g}CASE feature WHEN 'prediction' THEN 'prediction_drift' ELSE 'feature_drift' END AS type, feature, failed > 0 AS drift_detected,
    CASE WHEN failed >= 2 THEN 'high' WHEN failed = 1 THEN 'medium' ELSE 'low' END AS severity, ks AS ks_statistic, kd AS ks_drift,
    ws AS wasserstein_distance, wd AS wasserstein_drift, kl AS kl_divergence, ld AS kl_drift,
    abs(mc - mr) / (abs(mr) + 1e-8) * 100 AS mean_shift_pct, abs(sc - sr) / (abs(sr) + 1e-8) * 100 AS std_shift_pct, NULL::DOUBLE AS chi2_statistic, pv AS ks_pvalue FROM s
    UNION ALL SELECT {g}'regime_drift', 'regime', chi2 > 10, CASE WHEN chi2 > 20 THEN 'high' WHEN chi2 > 10 THEN 'medium' ELSE 'low' END,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, chi2, NULL FROM chi)"""


# The newest 1000 rows of each kind of event, and its newest 100 again.
_RECENT = """ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY timestamp DESC, event_id DESC) AS rn,
    count(*) OVER (PARTITION BY event_type) AS n FROM scored),
  sides AS (SELECT *, TRUE AS isref FROM ranked WHERE rn <= 1000 AND n >= 100 UNION ALL SELECT *, FALSE FROM ranked WHERE rn <= 100)"""
# The first half of the period, and the newest 100 rows.
_STREAMED = f"""sides AS (SELECT *, TRUE AS isref FROM scored WHERE {_HALVES}
    UNION ALL (SELECT *, FALSE FROM scored ORDER BY timestamp DESC, event_id DESC LIMIT 100))"""
_DOUBLES = ("ks_statistic", "wasserstein_distance", "kl_divergence", "mean_shift_pct", "std_shift_pct", "chi2_statistic")
_ALERTS = """al AS (SELECT user_id, timestamp, CASE WHEN price > 300 THEN 'HIGH' WHEN price > 150 THEN 'medium' WHEN price > 80 THEN 'low' ELSE 'notice' END AS severity
  FROM (SELECT user_id, date_trunc('day', timestamp)::TIMESTAMP AS timestamp, max(price) AS price FROM points GROUP BY 1, 2))"""


def _rate_sql(label: str) -> str:
    return _log_sql(
        f"""+ m AS (SELECT {label}, date_trunc('minute', timestamp)::TIMESTAMP AS mi, count(*) AS n FROM log GROUP BY 1, 2),
        w AS (SELECT {label}, mi - (i * INTERVAL 1 MINUTE) AS window_start, n FROM m, range(5) t(i))
        SELECT {label}, window_start, window_start + INTERVAL 5 MINUTE AS window_end, {sql_round('sum(n) / 3e2', 'rate')} FROM w GROUP BY 1, 2"""
    )


ORACLE = {
    "prediction_log": with_views(
        f"""+ {_SCORED} SELECT event_id, timestamp, regime_id, CASE regime_id WHEN 0 THEN 'volatile' WHEN 1 THEN 'neutral' ELSE 'stable' END AS regime_name,
        'mock' AS model_name, {sql_round('prediction', 'prediction')}, CASE regime_id WHEN 0 THEN 87e-2 WHEN 1 THEN 82e-2 ELSE 78e-2 END AS confidence,
        {sql_round('energy_production', 'latency_ms')} FROM scored""", "points"),
    "json_log_lines": _log_sql(
        f"""SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
        CASE WHEN event_type = 'error' THEN 'ERROR' WHEN status = 'error' THEN 'WARNING' ELSE 'INFO' END AS level, 'request' AS logger,
        CASE WHEN event_type = 'error' THEN 'Request failed' WHEN status = 'error' THEN 'Request completed with error' ELSE 'Request completed' END AS message,
        user_id::VARCHAR AS correlation_id, CASE WHEN status = 'error' THEN 422 ELSE 200 END AS status_code, {sql_round('latency_s', 'duration_ms')},
        CASE WHEN event_type = 'error' THEN 'ValueError' END AS error_type, CASE WHEN event_type = 'error' THEN 'bad "input"' END AS error_message FROM log"""),
    "correlation_ids": """SELECT event_type, CASE WHEN event_type <> 'view' THEN count(*) ELSE 0 END AS kept,
        CASE WHEN event_type = 'view' THEN count(*) ELSE 0 END AS made FROM events GROUP BY 1""",
    "op_duration": """WITH e AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS ended_at FROM lineitem GROUP BY 1, 2),
        s AS (SELECT o_orderkey, max(o_orderdate) AS started_at FROM orders GROUP BY 1)
        SELECT l_orderkey AS correlation_id, l_linenumber AS operation, started_at, ended_at, (epoch_us(ended_at) - epoch_us(started_at)) / 1e3 AS duration_ms
        FROM e JOIN s ON o_orderkey = l_orderkey WHERE ended_at >= started_at""",
    "metric_custom": _log_sql(
        f"SELECT event_type AS metric_name, regime_name AS regime, count(latency_s) AS n, {sql_round('max(latency_s)', 'largest')} FROM log GROUP BY 1, 2"),
    "metric_requests": _log_sql("SELECT regime_name, model_name, status, count(*) AS total FROM log GROUP BY ALL"),
    "metric_latency_hist": _log_sql(_hist_sql("latency_s", metrics.LATENCY_BUCKETS, "regime_name, model_name", "status = 'success'")),
    "metric_stage_hist": _log_sql(_hist_sql("latency_s", metrics.STAGE_BUCKETS)),
    "metric_regimes": _log_sql("SELECT regime_id, regime_name, count(*) AS total FROM log GROUP BY ALL"),
    "metric_confidence_hist": _log_sql(_hist_sql("confidence", metrics.CONFIDENCE_BUCKETS, "regime_name")),
    "metric_model_usage": _log_sql("SELECT regime_id, model_name, model_type, count(*) AS total FROM log GROUP BY ALL"),
    "metric_value_hist": _log_sql(_hist_sql("prediction", metrics.VALUE_BUCKETS, "", "status = 'success'")),
    "metric_errors": _log_sql("""SELECT event_type AS error_type, count(*) AS errors FROM log WHERE status = 'error' GROUP BY 1
        UNION ALL SELECT 'batch_item_failed', count(*) FROM log WHERE status = 'error' HAVING count(*) > 0"""),
    "rate_5m": _rate_sql("status"),
    "rate_5m_regime": _rate_sql("regime_name"),
    "hist_quantile": _log_sql(
        f"""+ h AS ({_hist_sql('latency_s', metrics.LATENCY_BUCKETS, 'regime_name, model_name', "status = 'success'")}),
        b AS (SELECT *, coalesce(lag("count") OVER w, 0) AS lower_n, coalesce(lag(le) OVER w, 0e0) AS lower_le, 95e-2 * max("count") OVER (PARTITION BY regime_name, model_name) AS rank
              FROM h WINDOW w AS (PARTITION BY regime_name, model_name ORDER BY le))
        SELECT regime_name, model_name, 95e-2 AS quantile,
          {sql_round("CASE WHEN isinf(le) THEN lower_le ELSE lower_le + (le - lower_le) * (rank - lower_n) / (\"count\" - lower_n) END", 'value')}
        FROM b WHERE "count" >= rank AND lower_n < rank"""),
    "ks_stat": with_views(f"+ {_tests_sql(_WATCHED)} SELECT feature, {sql_round('ks', 'ks_statistic', 9)} FROM dist", "points"),
    "wasserstein": with_views(f"+ {_tests_sql(_WATCHED)} SELECT feature, {sql_round('ws', 'wasserstein_distance', 9)} FROM dist", "points"),
    "kl_divergence": with_views(f"+ {_tests_sql(_WATCHED)} SELECT feature, {sql_round('kl', 'kl_divergence', 9)} FROM kl", "points"),
    "drift_distances_keyed": with_views(
        f"+ {_tests_sql(_WATCHED, 'event_type')} SELECT event_type, feature, {sql_round('ks', 'ks_statistic', 9)}, {sql_round('ws', 'wasserstein_distance', 9)}, {sql_round('kl', 'kl_divergence', 9)} FROM dist JOIN kl USING (event_type, feature)", "points"),
    "moment_shift": with_views(f"+ {_tests_sql(_WATCHED)} SELECT feature, {_MOMENT_COLUMNS} FROM mom", "points"),
    "regime_chi2": with_views(
        f"""+ {_SCORED}, {_chi_sql('event_type')} SELECT event_type, {sql_round('chi2', 'chi2_statistic')}, chi2 > 10 AS drift_detected,
        CASE WHEN chi2 > 20 THEN 'high' WHEN chi2 > 10 THEN 'medium' ELSE 'low' END AS severity,
        {', '.join(sql_round(f'{m}_{k}', f'{m}_{k}') for m in ('cur', 'ref') for k in range(3))} FROM chi""", "points"),
    "drift_severity": with_views(f"+ {_report_sql()} SELECT feature, severity, drift_detected FROM rep", "points"),
    "drift_report": with_views(
        f"+ {_report_sql()} SELECT " + ", ".join(sql_round(c, c, 9) if c in _DOUBLES else f"{c}::INTEGER AS {c}" if c in ("ks_drift", "wasserstein_drift", "kl_drift") else c for c in REPORT_COLUMNS) + " FROM rep", "points"),
    "drift_report_recent": with_views(
        f"+ {_report_sql('event_type', _RECENT, 'isref')} SELECT event_type, " + ", ".join(sql_round(c, c) if c in (*_DOUBLES, "ks_pvalue") else f"{c}::INTEGER AS {c}" if c in ("ks_drift", "wasserstein_drift", "kl_drift") else c for c in (*REPORT_COLUMNS, "ks_pvalue")) + " FROM rep", "points"),
    "stream_drift": with_views(
        f"+ {_report_sql('', _STREAMED, 'isref')} SELECT type, feature, severity, " + ", ".join(sql_round(c, c) for c in ("ks_statistic", "wasserstein_distance", "kl_divergence", "chi2_statistic")) + " FROM rep", "points"),
    "drift_reference": with_views(
        f"""SELECT event_id, user_id, timestamp, event_type, {', '.join(sql_round(c, c) for c in ('wind_speed', 'energy_production', 'temperature', 'price'))} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM points)
        WHERE rn <= 1000 AND n >= 60""", "points"),
    "recent_alerts": with_views(f"+ {_ALERTS} SELECT * FROM al WHERE timestamp > TIMESTAMP '2024-01-26 00:00:00'", "points"),
    "alert_gate": with_views(f"+ {_ALERTS} SELECT user_id, bool_or(severity = 'HIGH') AS send FROM al GROUP BY 1", "points"),
    "drift_status": with_views(
        f"""+ {_ALERTS} SELECT count(*) >= 100 AS reference_distributions_set, 3 AS n_features_tracked, CASE WHEN count(*) >= 100 THEN 3 ELSE 0 END AS n_reference_features,
        least(count(*), 1000) AS prediction_samples, least(count(*), 1000) AS regime_samples,
        (SELECT count(*) FROM al WHERE timestamp > TIMESTAMP '2024-01-26 00:00:00') AS recent_alerts_24h FROM points""", "points"),
    "drift_last": with_views(
        f"+ {_tests_sql(_WATCHED).replace(chr(60) + ' TIMESTAMP', '>= TIMESTAMP')} SELECT feature, {_MOMENT_COLUMNS}, TIMESTAMP '2024-01-31 12:00:00' AS checked_at FROM mom", "points"),
}
