"""Scaling, regime labels, segments, summaries, routing and scoring."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideshift.functions.values import clip
from tideshift.operators import regimes, scaling, scoring, summaries
from tideshift.operators.features import engineer_features
from tideshift.operators.validation import check_ranges
from tideshift.plans.feature_queries import ALL, _windows_sql
from tideshift.plans.ingest_queries import MEASURES, POINT_COLUMNS, REASON, SPINE, SQL_TEXT, _texts, daily_spine
from tideshift.plans.views import REGIME_CASE, hourly, keyed, points, rounded, sql_round, table, with_views

# One row per series and day, so a series has a few thousand rows at any scale and needs no size check.
KEY = {"keys": ("series",), "max_rows": None}

# Parameters of a fitted detector, taken as given here: start weights, means and variances of two measures.
POSTERIOR = {
    "columns": ("wind_speed", "price"),
    "start": (0.2, 0.5, 0.3),
    "means": ((20.0, 60.0), (10.0, 100.0), (3.0, 30.0)),
    "variances": ((25.0, 400.0), (16.0, 900.0), (4.0, 100.0)),
}


def labelled(spark, sf) -> DataFrame:
    """Keyed rows with the rule regime."""
    return regimes.rule_regime(keyed(spark, sf))


LABELLED = f"l AS (SELECT *, {REGIME_CASE} AS regime_id FROM keyed)"
NAME_CASE = "CASE {c} WHEN 0 THEN 'volatile' WHEN 1 THEN 'neutral' WHEN 2 THEN 'stable' END"


def breakpoints(spark, sf) -> DataFrame:
    """Segment ends of each series at the first row of every calendar quarter."""
    w = Window.partitionBy("series").orderBy("timestamp")
    rows = keyed(spark, sf).select("series", "timestamp", (F.row_number().over(w) - 1).alias("at"))
    ends = rows.groupBy("series", F.date_trunc("quarter", "timestamp")).agg(F.min("at").alias("segment_end"))
    return ends.select("series", "segment_end").where(F.col("segment_end") > 0)


SEGMENTS = """
  n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp) - 1 AS position FROM keyed),
  q AS (SELECT series, date_trunc('quarter', timestamp) AS quarter, min(position) AS segment_end FROM n GROUP BY 1, 2),
  e AS (SELECT series, segment_end FROM q WHERE segment_end > 0),
  c AS (SELECT series, count(*) AS n_segments FROM e GROUP BY 1),
  s AS (SELECT n.*, dense_rank() OVER (PARTITION BY n.series ORDER BY date_trunc('quarter', timestamp)) - 1 AS segment, n_segments
        FROM n JOIN c ON n.series = c.series),
  v AS (SELECT series, segment, count(*) AS n_rows, min(position) AS segment_start, max(position) + 1 AS segment_end,
        stddev_pop(energy_production) AS volatility FROM s WHERE segment < n_segments GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY round(volatility, 9), segment) - 1 AS rank, count(*) OVER (PARTITION BY series) AS m FROM v),
  g AS (SELECT series, segment, segment_end, CAST(2 - round_even(rank / greatest(m - 1, 1) * 2, 0) AS INTEGER) AS regime_id FROM r)"""


def segment_volatility(spark, sf) -> DataFrame:
    cut = regimes.assign_segments(keyed(spark, sf), breakpoints(spark, sf), **KEY)
    return regimes.segment_volatility(cut, "energy_production", ["series"])


def segment_regimes(spark, sf) -> DataFrame:
    found = segment_volatility(spark, sf).withColumn("volatility", F.round("volatility", 9))
    return regimes.segment_regimes(found, **KEY).select("series", "segment", "segment_end", "regime_id")


def segment_labels(spark, sf) -> DataFrame:
    rows = regimes.label_segments(keyed(spark, sf), breakpoints(spark, sf), "energy_production", **KEY)
    return rows.select("series", "timestamp", "segment")


def scored_by_rule(spark, sf) -> DataFrame:
    return scoring.score_batch(points(spark, sf))


def regime_errors(spark, sf) -> DataFrame:
    scored = scoring.fallback_prediction(labelled(spark, sf))
    return summaries.regression_errors(scored, "energy_production", "prediction", ["regime_id"])


def scaled(method: str):
    def query(spark, sf) -> DataFrame:
        rows = keyed(spark, sf)
        return rounded(scaling.apply_scaler(rows, scaling.fit_scaler(rows, MEASURES, method)))

    return query


def scaled_by_other(spark, sf) -> DataFrame:
    """Parameters fitted on the hourly series, stored, and applied to the keyed one; price stays as it is."""
    fitted = scaling.fit_scaler(hourly(spark, sf), ("wind_speed", "energy_production"), "zscore")
    return rounded(scaling.apply_scaler(keyed(spark, sf), fitted))


QUERIES = {
    "scale_minmax": scaled("minmax"),
    "scale_zscore": scaled("zscore"),
    "scale_apply": scaled_by_other,
    "regime_name": lambda s, d: table(s, d, "events").select(
        "event_id",
        regimes.regime_name(F.col("user_id") % 4).alias("batch_name"),
        regimes.regime_name(F.col("user_id") % 4, "unknown").alias("scored_name"),
    ),
    "route_heuristic": lambda s, d: rounded(
        regimes.rule_regime(points(s, d)).select("event_id", "regime_id", "regime_name", "confidence")
    ),
    "regime_transitions": lambda s, d: regimes.transitions(labelled(s, d), **KEY),
    "regime_distribution": lambda s, d: rounded(summaries.distribution(labelled(s, d))),
    "regime_means": lambda s, d: summaries.group_means(labelled(s, d), ("wind_speed", "price", "energy_production")),
    "regime_profile": lambda s, d: rounded(regimes.regime_profile(labelled(s, d), MEASURES)),
    "describe_all": lambda s, d: rounded(summaries.describe(keyed(s, d), MEASURES)),
    "n_regimes": lambda s, d: labelled(s, d).agg(F.countDistinct("regime_id").alias("n_regimes")),
    "time_bounds": lambda s, d: summaries.time_bounds(keyed(s, d), keys=["series"]),
    "latest_row": lambda s, d: summaries.latest_row(keyed(s, d), ["timestamp"], ["series"]),
    "recent_window": lambda s, d: summaries.recent_rows(keyed(s, d), 100, ["timestamp"], ["series"]),
    "recent_window_all": lambda s, d: rounded(summaries.recent_rows(points(s, d), 1000, ["timestamp", "event_id"])),
    "regression_errors": lambda s, d: rounded(regime_errors(s, d)),
    "min_samples": lambda s, d: summaries.enough_samples(
        regimes.rule_regime(daily_spine(s, d)).withColumnRenamed("regime_id", "regime"), "regime", 50
    ),
    "segment_volatility": lambda s, d: rounded(segment_volatility(s, d)),
    "segment_regime": segment_regimes,
    "segment_labels": segment_labels,
    "cpd_onehot": lambda s, d: regimes.one_hot(labelled(s, d).select("series", "timestamp", "regime_id")),
    "hmm_score_point": lambda s, d: rounded(
        scoring.point_posterior(points(s, d).select("event_id", "wind_speed", "price"), **POSTERIOR)
    ),
    "clip": lambda s, d: rounded(
        daily_spine(s, d).select(
            "series", "timestamp", *[clip_expression(c).alias(c) for c in ("wind_speed", "price")]
        )
    ),
    "fill_zero": lambda s, d: scoring.fill_zero(daily_spine(s, d), MEASURES),
    "range_validate": lambda s, d: check_ranges(points(s, d)).select("event_id", "reason"),
    "ts_default": lambda s, d: scoring.default_timestamp(
        _texts(s, d).select("event_id", F.col("HourUTC").alias("timestamp")), now=NOW
    ),
    "route_model": lambda s, d: scoring.route(labelled(s, d), {0: "boosted", 1: "neural"}).select(
        "series", "timestamp", "regime_id", "model_name"
    ),
    "score_fallback": lambda s, d: rounded(
        scoring.fallback_prediction(points(s, d)).select("event_id", "prediction", "model_name")
    ),
    "batch_score": lambda s, d: rounded(
        scored_by_rule(s, d).select("event_id", "status", "reason", "regime_id", "regime_name", "confidence", "prediction")
    ),
    "batch_counts": lambda s, d: scoring.batch_counts(scored_by_rule(s, d), ["event_type"]),
    "inference_sample": lambda s, d: scoring.tracked_sample(points(s, d), ["event_id"]).select("event_id"),
    "relabel_volatility": lambda s, d: regimes.relabel_by_volatility(labelled(s, d), "energy_production").select(
        "series", "timestamp", "regime_id"
    ),
    "flagship": lambda s, d: flagship(s, d),
}


def flagship(spark, sf) -> DataFrame:
    """Features of the hourly series, regimes by rule, and size and means of each regime."""
    rows = regimes.rule_regime(engineer_features(hourly(spark, sf), max_rows=None))
    measured = rows.groupBy("regime_id", "regime_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(c).alias(f"mean_{c}") for c in ("wind_speed", "energy_production", "price", "price_ma_24h", "price_cv_6h")],
    )
    return rounded(measured)


NOW = datetime(2024, 2, 1, 12)


def clip_expression(c: str):
    return clip(F.col(c), 2.0, 150.0)


def _density(k: int) -> str:
    start, means, variances = (POSTERIOR[n][k] for n in ("start", "means", "variances"))
    scale = math.log(start) - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
    terms = " + ".join(
        f"({c} - {m:e}) * ({c} - {m:e}) / {v:e}" for c, m, v in zip(POSTERIOR["columns"], means, variances)
    )
    return f"{scale!r}::DOUBLE - ({terms}) * 5e-1"


def _scale_sql(source: str, fitted: str, columns, expression: str) -> str:
    stats = ", ".join(
        f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in columns
    )
    scaled_columns = ", ".join(
        sql_round(expression.format(c=c), c) if c in columns else c for c in MEASURES
    )
    views = [source] if source == fitted else [source, fitted]
    return with_views(
        f"+ p AS (SELECT {stats} FROM {fitted}) SELECT series, timestamp, {scaled_columns} FROM {source}, p", *views
    )


def _describe(c: str, by: str, source: str) -> str:
    return f"""SELECT {by} '{c}' AS column_name, count({c}) AS "count", {sql_round(f'avg({c})', 'mean')},
      {sql_round(f'stddev_samp({c})', 'std')}, min({c}) AS "min", {sql_round(f'quantile_cont({c}, 0.25)', 'p25')},
      {sql_round(f'quantile_cont({c}, 0.5)', 'p50')}, {sql_round(f'quantile_cont({c}, 0.75)', 'p75')}, max({c}) AS "max"
      FROM {source}"""


ZSCORE = "CASE WHEN sd_{c} = 0 THEN 0e0 ELSE ({c} - mu_{c}) / sd_{c} END"
MINMAX = "CASE WHEN hi_{c} = lo_{c} THEN 0e0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END"
RULE_NAME = NAME_CASE.format(c="regime_id")
CONFIDENCE = "CASE regime_id WHEN 0 THEN 87e-2 WHEN 1 THEN 82e-2 ELSE 78e-2 END"
_D = [f"d{k}" for k in range(3)]
_POST = f"""d AS (SELECT event_id, wind_speed, price, {', '.join(f'{_density(k)} AS d{k}' for k in range(3))} FROM points),
  w AS (SELECT *, greatest(d0, d1, d2) AS best FROM d), x AS (SELECT *, exp(d0 - best) + exp(d1 - best) + exp(d2 - best) AS total FROM w)"""

ORACLE = {
    "scale_minmax": _scale_sql("keyed", "keyed", MEASURES, MINMAX),
    "scale_zscore": _scale_sql("keyed", "keyed", MEASURES, ZSCORE),
    "scale_apply": _scale_sql("keyed", "hourly", ("wind_speed", "energy_production"), ZSCORE),
    "regime_name": f"""SELECT event_id, {NAME_CASE.format(c='user_id % 4')} AS batch_name,
      coalesce({NAME_CASE.format(c='user_id % 4')}, 'unknown') AS scored_name FROM events""",
    "route_heuristic": with_views(
        f"SELECT event_id, regime_id, {RULE_NAME} AS regime_name, {CONFIDENCE} AS confidence FROM (SELECT *, {REGIME_CASE} AS regime_id FROM points)", "points"),
    "regime_transitions": with_views(
        f"""+ {LABELLED}, t AS (SELECT series, timestamp, regime_id, lag(regime_id) OVER (PARTITION BY series ORDER BY timestamp) AS from_regime FROM l)
        SELECT series, timestamp, from_regime, regime_id AS to_regime, {NAME_CASE.format(c='from_regime')} AS from_regime_name,
               {RULE_NAME} AS to_regime_name FROM t WHERE from_regime <> regime_id""", "keyed"),
    "regime_distribution": with_views(
        f"+ {LABELLED} SELECT regime_id, count(*) AS n_rows, {sql_round('count(*) * 1e2 / sum(count(*)) OVER ()', 'percent')} FROM l GROUP BY 1", "keyed"),
    "regime_means": with_views(
        f"+ {LABELLED} SELECT regime_id, " + ", ".join(f"round_even(avg({c}), 2) AS {c}" for c in ("wind_speed", "price", "energy_production")) + " FROM l GROUP BY 1", "keyed"),
    "regime_profile": with_views(
        f"+ {LABELLED}, x AS (SELECT regime_id, count(*) AS n_samples, min(timestamp) AS start, max(timestamp) AS \"end\" FROM l GROUP BY 1), y AS ("
        + " UNION ALL ".join(_describe(c, "regime_id,", "l") + " GROUP BY regime_id" for c in MEASURES)
        + f") SELECT y.*, n_samples, start, \"end\", {NAME_CASE.format(c='y.regime_id')} AS regime_name FROM y JOIN x ON x.regime_id = y.regime_id", "keyed"),
    "describe_all": with_views(" UNION ALL ".join(_describe(c, "", "keyed") for c in MEASURES), "keyed"),
    "n_regimes": with_views(f"+ {LABELLED} SELECT count(DISTINCT regime_id) AS n_regimes FROM l", "keyed"),
    "time_bounds": with_views("SELECT series, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp FROM keyed GROUP BY 1", "keyed"),
    "latest_row": with_views("SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) = 1", "keyed"),
    "recent_window": with_views("SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) <= 100", "keyed"),
    "recent_window_all": with_views(f"SELECT {POINT_COLUMNS} FROM points ORDER BY points.timestamp DESC, points.event_id DESC LIMIT 1000", "points"),
    "regression_errors": with_views(
        f"""+ {LABELLED}, e AS (SELECT regime_id, energy_production * 105e-2 - energy_production AS e FROM l)
        SELECT regime_id, count(*) AS n_samples, {sql_round('avg(abs(e))', 'mae')}, {sql_round('sqrt(avg(e * e))', 'rmse')} FROM e GROUP BY 1""", "keyed"),
    "min_samples": with_views(
        f"""+{SPINE}, l AS (SELECT *, {REGIME_CASE} AS regime FROM daily)
        SELECT regime, count(*) AS n_samples FROM l WHERE wind_speed IS NOT NULL GROUP BY 1 HAVING count(*) >= 50""", "keyed"),
    "segment_volatility": with_views(
        f"+{SEGMENTS} SELECT series, segment, n_rows, segment_start, segment_end, {sql_round('volatility', 'volatility')} FROM v", "keyed"),
    "segment_regime": with_views(f"+{SEGMENTS} SELECT * FROM g", "keyed"),
    "segment_labels": with_views(f"+{SEGMENTS} SELECT series, timestamp, segment FROM s", "keyed"),
    "cpd_onehot": with_views(
        f"+ {LABELLED} SELECT series, timestamp, regime_id, " + ", ".join(f"CASE WHEN regime_id = {k} THEN 1e0 ELSE 0e0 END AS regime_proba_{k}" for k in range(3)) + " FROM l", "keyed"),
    "hmm_score_point": with_views(
        f"+ {_POST} SELECT event_id, {sql_round('wind_speed', 'wind_speed')}, {sql_round('price', 'price')}, "
        + ", ".join(sql_round(f"exp(d{k} - best) / total", f"regime_proba_{k}") for k in range(3))
        + f", CASE best WHEN d0 THEN 0 WHEN d1 THEN 1 ELSE 2 END AS regime_id, {sql_round('1 / total', 'confidence')} FROM x", "points"),
    "clip": with_views(
        f"+{SPINE} SELECT series, timestamp, " + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, 2e0), 15e1) END AS {c}" for c in ("wind_speed", "price")) + " FROM daily", "keyed"),
    "fill_zero": with_views(f"+{SPINE} SELECT series, timestamp, " + ", ".join(f"coalesce({c}, 0e0) AS {c}" for c in MEASURES) + " FROM daily", "keyed"),
    "range_validate": with_views(f"SELECT event_id, {REASON} AS reason FROM points", "points"),
    "ts_default": f"SELECT event_id, coalesce(TRY_CAST({SQL_TEXT} AS TIMESTAMP), TIMESTAMP '2024-02-01 12:00:00') AS timestamp FROM events",
    "route_model": with_views(
        f"+ {LABELLED} SELECT series, timestamp, regime_id, CASE regime_id WHEN 0 THEN 'boosted' WHEN 1 THEN 'neural' ELSE 'mock' END AS model_name FROM l", "keyed"),
    "score_fallback": with_views(f"SELECT event_id, {sql_round('energy_production * 105e-2', 'prediction')}, 'mock' AS model_name FROM points", "points"),
    "batch_score": with_views(
        f"""+ c AS (SELECT *, {REASON} AS reason, {REGIME_CASE} AS rule FROM points), g AS (SELECT *, CASE WHEN reason IS NULL THEN rule END AS regime_id FROM c)
        SELECT event_id, CASE WHEN reason IS NULL THEN 'success' ELSE 'error' END AS status, reason, regime_id, {RULE_NAME} AS regime_name,
          CASE WHEN reason IS NULL THEN {CONFIDENCE} END AS confidence,
          {sql_round('CASE WHEN reason IS NULL THEN energy_production * 105e-2 END', 'prediction')} FROM g""", "points"),
    "batch_counts": with_views(
        f"""SELECT event_type, count(*) FILTER (reason IS NULL) AS n_succeeded, count(*) FILTER (reason IS NOT NULL) AS n_failed
        FROM (SELECT event_type, {REASON} AS reason FROM points) GROUP BY 1""", "points"),
    "inference_sample": "SELECT event_id FROM events WHERE substr(md5(event_id || '|42'), 1, 8) < '028f5c28'",
    "relabel_volatility": with_views(
        f"""+ {LABELLED}, o AS (SELECT regime_id, row_number() OVER (ORDER BY stddev_pop(energy_production) DESC) - 1 AS r FROM l GROUP BY 1)
        SELECT series, timestamp, CAST(o.r AS INTEGER) AS regime_id FROM l JOIN o ON l.regime_id = o.regime_id""", "keyed"),
}

ORACLE["flagship"] = (
    "SELECT regime_id, regime_name, count(*) AS n_rows, "
    + ", ".join(
        sql_round(f"avg({c})", f"mean_{c}")
        for c in ("wind_speed", "energy_production", "price", "price_ma_24h", "price_cv_6h")
    )
    + f" FROM (SELECT *, {RULE_NAME} AS regime_name FROM (SELECT *, {REGIME_CASE} AS regime_id FROM ("
    + _windows_sql("hourly", ALL, calendar=True, dropna=True)
    + "))) GROUP BY 1, 2"
)
