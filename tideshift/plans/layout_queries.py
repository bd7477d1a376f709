"""Queries over series cut into short runs or blocks, each with the SQL of its uncut counterpart, and over odd layouts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.operators import drift, features, gaps, hmm, joins, metrics, regimes
from tideshift.plans import feature_queries, ingest_queries, model_queries, monitoring_queries, regime_queries
from tideshift.plans.views import hourly, keyed, points, rounded, sql_round, with_views
from tideshift.session import scratch_path
from tideshift.sources import lake

# Far below the length of every series, so that all of them are cut.
CUT = {"keys": ("series",), "max_rows": 250}
BLOCK_ROWS = 64


def _windows(kind: str):
    return lambda s, d: rounded(features.window_columns(keyed(s, d), kind, **CUT))


def asof_cut(spark, sf) -> DataFrame:
    left = ingest_queries._kind(spark, sf, "purchase", "purchase_id", "amount")
    right = ingest_queries._kind(spark, sf, "click", "click_id", "click")
    return joins.nearest_join(left, right, 60, tie=["click_id"], right_ts="click_at", max_rows=500)


def segment_labels_cut(spark, sf) -> DataFrame:
    ends = regime_queries.breakpoints(spark, sf)
    rows = regimes.label_segments(keyed(spark, sf), ends, "energy_production", **CUT)
    return rows.select("series", "timestamp", "segment")


def blocks(spark, sf) -> hmm.Blocks:
    return hmm.pack(keyed(spark, sf), model_queries.COLUMNS, block_rows=BLOCK_ROWS, **CUT)


FIRST, LAST = datetime(2024, 1, 9, 6), datetime(2024, 1, 20, 18)


def lake_run_layout(spark, sf) -> DataFrame:
    """A lake stored by day of run: every third day brings the four days before it; read by time, each row once."""
    path, rows = scratch_path(spark, "lake"), hourly(spark, sf)
    for day in range(4, 32, 3):
        end = datetime(2024, 1, day)
        batch = rows.where((F.col("timestamp") >= end - timedelta(days=4)) & (F.col("timestamp") < end))
        lake.write_lake(batch.withColumn("ingestion_timestamp", F.lit(end)), path, run_end=end)
    found = lake.latest_ingested(lake.read_lake(spark, path, FIRST, LAST), [])
    return rounded(found.drop("ingestion_timestamp", *lake.PARTS))


def _without_key(spark, sf) -> DataFrame:
    """The keyed rows, with every tenth series turned into the one without a key."""
    rows = keyed(spark, sf)
    return rows.withColumn("series", F.when(F.col("series") % 10 != 3, F.col("series"))).where("series is not null or energy_production > 0")


def spine_missing_key(spark, sf) -> DataFrame:
    rows = _without_key(spark, sf)
    once = rows.groupBy("series", "timestamp").agg(*[F.max(c).alias(c) for c in ("wind_speed", "energy_production")])
    return gaps.on_spine(once, 86400, ["series"])


def errors_by_type(spark, sf) -> DataFrame:
    log = monitoring_queries.prediction_log(spark, sf)
    failed = log.where("status = 'error'").withColumnRenamed("event_type", "error_type")
    return rounded(metrics.sliding_rate(failed, ["error_type"]))


def quantile_by_window(spark, sf) -> DataFrame:
    log = monitoring_queries.prediction_log(spark, sf).where("status = 'success'")
    return rounded(metrics.windowed_quantile(log, "latency_s", metrics.LATENCY_BUCKETS, 0.95))


def batches_scored(spark, sf) -> DataFrame:
    """Scored batches by outcome; each user's requests are a batch."""
    return metrics.batch_counter(monitoring_queries.prediction_log(spark, sf), ["user_id"])


def reference_updated(spark, sf) -> DataFrame:
    """Each kind of event is checked against its first half; where nothing drifts, the newest rows take over."""
    rows, by = points(spark, sf), ["event_type"]
    reference, current = monitoring_queries._halves(rows)
    report = drift.drift_report(reference, current, prediction=None, regime=None, by=by, checked_at=monitoring_queries.CHECKED)
    kept = drift.updated_reference(reference, current, report, ["timestamp", "event_id"], by)
    return kept.select("event_id", "event_type")


QUERIES = {
    "roll_mean_cut": _windows("mean"),
    "roll_std_cut": _windows("std"),
    "rate_of_change_cut": _windows("rate"),
    "lags_cut": _windows("lag"),
    "asof_nearest_cut": asof_cut,
    "ffill_limited_cut": lambda s, d: gaps.forward_fill(ingest_queries.daily_spine(s, d), 2, **CUT),
    "regime_profile_cut": lambda s, d: rounded(
        regimes.regime_profile(regime_queries.labelled(s, d), ingest_queries.MEASURES, max_rows=500)
    ),
    "drift_distances_cut": lambda s, d: rounded(
        drift.distances(*monitoring_queries._halves(points(s, d)), drift.WATCHED, by=["event_type"], max_rows=300), 9
    ),
    "segment_labels_cut": segment_labels_cut,
    "hmm_decode_cut": lambda s, d: hmm.decode(blocks(s, d), model_queries.MODEL),
    "hmm_posterior_cut": lambda s, d: rounded(hmm.posterior(blocks(s, d), model_queries.MODEL)),
    "hmm_loglik_cut": lambda s, d: rounded(hmm.log_likelihood(blocks(s, d), model_queries.MODEL)),
    "lake_run_layout": lake_run_layout,
    "spine_missing_key": spine_missing_key,
    "rate_5m_error": errors_by_type,
    "quantile_5m": quantile_by_window,
    "metric_batches": batches_scored,
    "drift_reference_update": reference_updated,
}

_ERROR_RATES = monitoring_queries._log_sql(
    f"""+ m AS (SELECT event_type AS error_type, date_trunc('minute', timestamp)::TIMESTAMP AS mi, count(*) AS n FROM log WHERE status = 'error' GROUP BY 1, 2),
    w AS (SELECT error_type, mi - (i * INTERVAL 1 MINUTE) AS window_start, n FROM m, range(5) t(i))
    SELECT error_type, window_start, window_start + INTERVAL 5 MINUTE AS window_end, {sql_round('sum(n) / 3e2', 'rate')} FROM w GROUP BY 1, 2"""
)
_BOUNDS = ", ".join([*[f"{b:e}" for b in metrics.LATENCY_BUCKETS], "'inf'::DOUBLE"])
_WINDOW_QUANTILES = monitoring_queries._log_sql(
    f"""+ h AS (SELECT date_trunc('minute', timestamp)::TIMESTAMP - (i * INTERVAL 1 MINUTE) AS window_start, le, count(*) FILTER (latency_s <= le) AS n
      FROM log, (SELECT unnest([{_BOUNDS}]) AS le), range(5) t(i) WHERE status = 'success' GROUP BY 1, 2),
    r AS (SELECT *, coalesce(lag(n) OVER w, 0) AS below, lag(le) OVER w AS start, 95e-2 * max(n) OVER (PARTITION BY window_start) AS rank FROM h
      WINDOW w AS (PARTITION BY window_start ORDER BY le))
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, 95e-2 AS quantile,
      {sql_round("CASE WHEN isinf(le) THEN start ELSE coalesce(start, 0e0) + (le - coalesce(start, 0e0)) * ((rank - below) / (n - below)) END", "value")}
    FROM r WHERE n >= rank AND below < rank"""
)
_REFERENCE = with_views(
    f"""+ {monitoring_queries._tests_sql(drift.WATCHED, 'event_type')},
    j AS (SELECT event_type, feature, nr, nc, ks, ws, kl, ks * ks * nr * nc / (nr + nc) AS z2 FROM mom JOIN dist USING (event_type, feature) JOIN kl USING (event_type, feature)),
    p AS (SELECT *, CASE WHEN z2 < 4e-2 THEN 1e0 ELSE {monitoring_queries._KOLMOGOROV} END AS pv FROM j),
    bad AS (SELECT event_type, bool_or(nr >= 10 AND nc >= 10 AND (pv < 5e-2 OR ws > 3e-1 OR kl > 1e-1)) AS drifted, min(nc) AS nc FROM p GROUP BY 1),
    newest AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY timestamp DESC, event_id DESC) AS rn FROM points WHERE timestamp >= TIMESTAMP '2024-01-16')
    SELECT event_id, event_type FROM newest JOIN bad USING (event_type) WHERE NOT drifted AND nc >= 100 AND rn <= 1000
    UNION ALL SELECT event_id, event_type FROM points LEFT JOIN bad USING (event_type)
      WHERE timestamp < TIMESTAMP '2024-01-16' AND (coalesce(drifted, TRUE) OR nc < 100)""",
    "points",
)

ORACLE = {
    **{f"{n}_cut": feature_queries.ORACLE[n] for n in ("roll_mean", "roll_std", "rate_of_change", "lags") if n in feature_queries.ORACLE},
    "asof_nearest_cut": ingest_queries.ORACLE["asof_nearest"],
    "ffill_limited_cut": ingest_queries.ORACLE["ffill_limited"],
    "regime_profile_cut": regime_queries.ORACLE["regime_profile"],
    "drift_distances_cut": monitoring_queries.ORACLE["drift_distances_keyed"],
    "segment_labels_cut": regime_queries.ORACLE["segment_labels"],
    "hmm_decode_cut": model_queries.ORACLE["hmm_decode"],
    "hmm_posterior_cut": model_queries.ORACLE["hmm_posterior"],
    "hmm_loglik_cut": model_queries.ORACLE["hmm_loglik"],
    "lake_run_layout": with_views(
        f"""SELECT timestamp, {', '.join(sql_round(c, c) for c in ('wind_speed', 'energy_production', 'temperature', 'price'))} FROM hourly
        WHERE timestamp BETWEEN TIMESTAMP '2024-01-09 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'""",
        "hourly",
    ),
    "spine_missing_key": with_views(
        """+ k AS (SELECT CASE WHEN series % 10 <> 3 THEN series END AS series, timestamp, max(wind_speed) AS wind_speed, max(energy_production) AS energy_production
          FROM keyed WHERE series % 10 <> 3 OR energy_production > 0 GROUP BY 1, 2),
        s AS (SELECT series, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 DAY)) AS timestamp FROM k GROUP BY 1)
        SELECT s.series, s.timestamp, wind_speed, energy_production FROM s LEFT JOIN k ON s.series IS NOT DISTINCT FROM k.series AND s.timestamp = k.timestamp""",
        "keyed",
    ),
    "rate_5m_error": _ERROR_RATES,
    "quantile_5m": _WINDOW_QUANTILES,
    "metric_batches": monitoring_queries._log_sql(
        """SELECT outcome, count(*) AS batches FROM (SELECT user_id, CASE WHEN bool_and(status = 'success') THEN 'success'
        WHEN bool_or(status = 'success') THEN 'partial' ELSE 'error' END AS outcome FROM log GROUP BY 1) GROUP BY 1"""
    ),
    "drift_reference_update": _REFERENCE,
}
