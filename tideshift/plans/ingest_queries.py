"""Payloads, normalisation, joins on time, gap filling, validation and the lake."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.operators import gaps, joins, validation
from tideshift.plans.ingest import ingest_batch
from tideshift.plans.views import hourly, keyed, points, rounded, sql_round, table, with_views
from tideshift.session import scratch_path
from tideshift.sources import lake
from tideshift.sources import payloads as pay
from tideshift.sources.logs import iso_text

# One row per series and day, so a series has a few thousand rows at any scale and needs no size check.
KEY = {"keys": ("series",), "max_rows": None}
RECORD = T.StructType(
    [
        T.StructField("HourUTC", T.StringType()),
        T.StructField("SpotPriceDKK", T.DoubleType()),
        T.StructField("PriceArea", T.StringType()),
    ]
)


def _iso(c):
    return iso_text(F.col(c))


SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def record_payloads(spark, sf) -> DataFrame:
    """One text per event with two records, in each of the accepted shapes and one that is not."""
    record = F.struct(
        _iso("ts").alias("HourUTC"), F.col("value").alias("SpotPriceDKK"), F.col("event_type").alias("PriceArea")
    )
    double = F.struct(
        _iso("ts").alias("HourUTC"), (F.col("value") * 2).alias("SpotPriceDKK"), F.lit("all").alias("PriceArea")
    )
    rows = F.array(record, double)
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.to_json(F.struct(rows.alias("records"))))
        .when(kind == "view", F.to_json(F.struct(rows.alias("data"))))
        .when(kind == "purchase", F.to_json(rows))
        .when(kind == "signup", F.to_json(F.struct(rows.alias("data"), rows.alias("records"))))
        .otherwise(F.lit('{"message": "no data"}'))
    )
    return table(spark, sf, "events").select("event_id", text.alias("payload"))


def weather_payloads(spark, sf) -> DataFrame:
    times = F.array(_iso("ts"), iso_text(F.col("ts") + F.expr("INTERVAL 1 HOUR")), F.lit("n/a"))
    values = F.array(F.col("value"), F.col("value") + 1, F.col("value") + 2)
    body = F.struct(
        times.alias("time"), values.alias("temperature_2m"), F.reverse(values).alias("wind_speed_10m")
    )
    return table(spark, sf, "events").select("event_id", F.to_json(F.struct(body.alias("hourly"))).alias("payload"))


def _prices(spark, sf) -> DataFrame:
    """Priced events per hour and area, in whole cents."""
    return table(spark, sf, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        F.round(F.col("value") * 100).alias("price"),
        F.col("event_type").alias("PriceArea"),
    )


def _texts(spark, sf) -> DataFrame:
    text = (
        F.when(F.col("event_type") == "click", _iso("ts"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "error", F.lit("not a time"))
    )
    return table(spark, sf, "events").select("event_id", "value", text.alias("HourUTC"))


SQL_TEXT = f"""CASE event_type WHEN 'click' THEN {SQL_ISO} WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 'error' THEN 'not a time' END"""


def _kind(spark, sf, kind, ts, value) -> DataFrame:
    rows = table(spark, sf, "events").where(F.col("event_type") == kind)
    return rows.select(F.col("ts").alias("timestamp"), F.col("event_id").alias(ts), F.col("value").alias(value))


def asof(spark, sf) -> DataFrame:
    left, right = _kind(spark, sf, "purchase", "purchase_id", "amount"), _kind(spark, sf, "click", "click_id", "click")
    return joins.nearest_join(left, right, 60, tie=["click_id"], right_ts="click_at")


def asof_by_user(spark, sf) -> DataFrame:
    events = table(spark, sf, "events")
    left = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("timestamp"), "event_id")
    right = events.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("timestamp"), F.col("event_id").alias("view_id")
    )
    return joins.nearest_join(left, right, 1440, keys=["user_id"], tie=["view_id"])


def _asof_sql(left: str, right: str, by: str, minutes: int, out: str) -> str:
    """Both one-sided matches, then the nearer one; equal distance goes backward."""
    on = f"l.{by} = r.{by} AND " if by else ""
    return f"""
      WITH l AS ({left}), r AS ({right}),
      b AS (SELECT l.*, r.rid AS b_id, r.rval AS b_val, r.timestamp AS b_ts FROM l ASOF LEFT JOIN r ON {on}l.timestamp >= r.timestamp),
      a AS (SELECT l.lid AS a_lid, r.rid AS a_id, r.rval AS a_val, r.timestamp AS a_ts FROM l ASOF LEFT JOIN r ON {on}l.timestamp < r.timestamp),
      d AS (SELECT *, epoch_us(b.timestamp) - epoch_us(b_ts) AS back, epoch_us(a_ts) - epoch_us(b.timestamp) AS ahead
            FROM b JOIN a ON b.lid = a.a_lid),
      c AS (SELECT *, CASE WHEN back <= {minutes * 60_000_000} AND (ahead IS NULL OR back <= ahead) THEN 1
                           WHEN ahead <= {minutes * 60_000_000} THEN 2 END AS pick FROM d)
      SELECT {out} FROM c"""


def production_heuristic(spark, sf) -> DataFrame:
    source = table(spark, sf, "events").select(
        "event_id",
        _iso("ts").alias("TimeUTC"),
        F.concat(F.col("event_type"), F.lit("-type")).alias("ProductionType"),
        (F.col("value") * 2).alias("grossProductionMWh"),
        F.col("value").alias("SpotPriceEUR"),
    )
    return pay.name_production(pay.resolve_timestamp(source))


def price_heuristic(spark, sf) -> DataFrame:
    source = table(spark, sf, "events").select(
        "event_id", F.col("value").alias("SpotPriceEUR"), (F.col("value") * 7).alias("SpotPriceDKK")
    )
    return pay.name_price(source)


def composite(spark, sf) -> DataFrame:
    events = table(spark, sf, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")

    def source(kind: str, name: str) -> DataFrame:
        rows = events.where(F.col("event_type") == kind).groupBy(hour)
        return rows.agg(F.max("value").alias(name), F.count(F.lit(1)).alias("n"))

    return joins.merge_sources([source("click", "price"), source("view", "temperature"), source("purchase", "wind_speed")])


def lake_round(spark, sf, **bounds) -> DataFrame:
    path = scratch_path(spark, "lake")
    lake.write_lake(points(spark, sf), path)
    return rounded(lake.read_lake(spark, path, **bounds))


def quarantined(spark, sf) -> DataFrame:
    path = scratch_path(spark, "quarantine")
    _, bad = validation.split_valid(points(spark, sf), ts="timestamp")
    lake.write_quarantine(bad, path, datetime(2024, 1, 1), datetime(2024, 1, 31))
    back = spark.read.schema("start_date string, end_date string, record string, reason string").json(path)
    record = F.from_json("record", "event_id long, price double, timestamp string")
    return rounded(
        back.select("reason", "start_date", record["event_id"].alias("event_id"), record["price"].alias("price"))
    )


def stored_features(spark, sf) -> DataFrame:
    """Two versions saved, the newest loaded."""
    from tideshift.operators.features import window_columns

    store = scratch_path(spark, "features")
    lake.save_features(window_columns(keyed(spark, sf), "lag", **KEY), store, "1.0.0", now=datetime(2024, 1, 1))
    lake.save_features(window_columns(keyed(spark, sf), "spread", **KEY), store, "1.1.0", now=datetime(2024, 1, 2))
    return rounded(lake.load_features(spark, store))


def feature_set_list(spark, sf) -> DataFrame:
    from tideshift.operators.features import add_calendar

    store = scratch_path(spark, "features")
    lake.save_features(add_calendar(keyed(spark, sf)), store, "2.0.0", now=datetime(2024, 1, 1))
    return lake.feature_sets(spark, store).select("feature_set_name", "version", "n_samples", "n_features", "created_at")


def daily_spine(spark, sf) -> DataFrame:
    return gaps.on_spine(keyed(spark, sf), 86400, KEY["keys"])


def batch(spark, sf) -> DataFrame:
    """Production, prices and weather from three kinds of events, joined, filled, checked."""
    events = table(spark, sf, "events")
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("timestamp")

    def source(kind: str, *columns) -> DataFrame:
        return events.where(F.col("event_type") == kind).select(minute, *columns)

    cents = F.round(F.col("value") * 100)
    energy = source("purchase", (cents / 4).alias("production"), F.col("user_id").alias("ProductionType"))
    prices = source("click", (cents * 2).alias("SpotPriceDKK"), F.col("user_id").alias("PriceArea"))
    weather = source("view", (cents / 1024).alias("wind_speed"), (cents / 512 - 32).alias("temperature"))
    once = weather.groupBy("timestamp").agg(F.max("wind_speed").alias("wind_speed"), F.max("temperature").alias("temperature"))
    return rounded(ingest_batch(energy, prices, once, source="events").drop("ingestion_timestamp"))


QUERIES = {
    "payload_explode": lambda s, d: pay.explode_records(record_payloads(s, d), RECORD),
    "payload_reject": lambda s, d: pay.rejected_payloads(record_payloads(s, d), RECORD).select("event_id"),
    "weather_arrays": lambda s, d: rounded(pay.explode_weather(weather_payloads(s, d))),
    "high_watermark": lambda s, d: pay.high_watermark(table(s, d, "events"), "ts", ["event_type"]),
    "lookback_window": lambda s, d: pay.ingest_window(table(s, d, "events"), ts="ts", lookback_hours=24 * 7).select("event_id", "ts"),
    "parse_ts": lambda s, d: _texts(s, d).select("event_id", pay.parse_timestamp(F.col("HourUTC")).alias("parsed")),
    "resolve_timestamp": lambda s, d: pay.resolve_timestamp(_texts(s, d)),
    "local_to_utc": lambda s, d: _texts(s, d).select(
        "event_id", pay.parse_timestamp(F.col("HourUTC"), "Europe/Copenhagen").alias("parsed")
    ),
    "field_map": lambda s, d: pay.normalize(
        table(s, d, "events").select("event_id", "ts", "value", "user_id"), "ts",
        {"price": "value", "energy_production": "user_id", "wind_speed": "absent"}, keys=["event_id"],
    ),
    "price_heuristic": price_heuristic,
    "production_heuristic": production_heuristic,
    "price_area_mean": lambda s, d: rounded(pay.mean_price(_prices(s, d))),
    "production_sum": lambda s, d: pay.total_production(
        _prices(s, d).select("timestamp", F.when(F.col("PriceArea") == "click", F.col("price")).alias("energy_production"))
    ),
    "iso_format": lambda s, d: table(s, d, "events").select("event_id", _iso("ts").alias("iso"), F.date_format("ts", "yyyyMMdd'T'HHmmss").alias("stamp")),
    "ingest_meta": lambda s, d: validation.stamp_batch(points(s, d), "events").select(
        "event_id", "data_source", F.col("ingestion_timestamp").isNotNull().cast("int").alias("stamped")
    ),
    "asof_nearest": asof,
    "asof_nearest_by_user": asof_by_user,
    "join_inner_time": lambda s, d: joins.exact_join(
        hourly(s, d).select("timestamp", "price"), _prices(s, d).select("timestamp", "PriceArea", F.col("price").alias("cents"))
    ),
    "join_left_weather": lambda s, d: joins.exact_join(
        keyed(s, d).select("series", "timestamp", "price"),
        table(s, d, "orders").groupBy(F.col("o_orderdate").alias("timestamp")).agg(F.count(F.lit(1)).alias("n_orders")), how="left",
    ),
    "composite_outer": composite,
    "hourly_spine": lambda s, d: gaps.spine(hourly(s, d)),
    "daily_spine_keyed": daily_spine,
    "ffill_limited": lambda s, d: gaps.forward_fill(daily_spine(s, d), 2, **KEY),
    "null_ratio": lambda s, d: rounded(validation.null_ratios(daily_spine(s, d))),
    "dup_timestamps": lambda s, d: validation.duplicate_timestamps(table(s, d, "lineitem"), "l_shipdate", ["l_suppkey"]),
    "ingest_batch": batch,
    "lake_roundtrip": lambda s, d: lake_round(s, d),
    "lake_pruned_scan": lambda s, d: lake_round(s, d, start=datetime(2024, 1, 9, 6), end=datetime(2024, 1, 20, 18)),
    "quarantine": quarantined,
    "feature_store_latest": stored_features,
    "feature_store_write": feature_set_list,
}

POINT_COLUMNS = "event_id, user_id, timestamp, event_type, " + ", ".join(
    sql_round(c, c) for c in ("wind_speed", "energy_production", "temperature", "price")
)
PARTS = "year(timestamp)::INTEGER AS year, month(timestamp)::INTEGER AS month, day(timestamp)::INTEGER AS day"
SPINE = """
  spine AS (SELECT series, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 DAY)) AS timestamp FROM keyed GROUP BY 1),
  daily AS (SELECT s.series, s.timestamp, wind_speed, energy_production, temperature, price
            FROM spine s LEFT JOIN keyed k ON s.series = k.series AND s.timestamp = k.timestamp)"""
MEASURES = ("wind_speed", "energy_production", "temperature", "price")
REASON = """CASE WHEN timestamp IS NULL THEN 'timestamp'
  WHEN wind_speed IS NULL OR wind_speed NOT BETWEEN 0 AND 30 THEN 'wind_speed'
  WHEN energy_production IS NULL OR energy_production NOT BETWEEN 0 AND 1000 THEN 'energy_production'
  WHEN temperature IS NULL OR temperature NOT BETWEEN -40 AND 50 THEN 'temperature'
  WHEN price IS NULL OR price NOT BETWEEN 0 AND 500 THEN 'price' END"""
_FILL2 = ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {c}"
    for c in MEASURES
)
_FILL_ALL = ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {c}" for c in MEASURES
)
_EVENTS = "SELECT ts AS timestamp, {cols} FROM events WHERE event_type = '{kind}'"

ORACLE = {
    "payload_explode": f"""
      SELECT event_id, {SQL_ISO} AS "HourUTC", value AS "SpotPriceDKK", event_type AS "PriceArea" FROM events WHERE event_type <> 'error'
      UNION ALL SELECT event_id, {SQL_ISO}, value * 2, 'all' FROM events WHERE event_type <> 'error'""",
    "payload_reject": "SELECT event_id FROM events WHERE event_type = 'error'",
    "weather_arrays": f"""
      SELECT event_id, timestamp, {sql_round('temperature', 'temperature')}, {sql_round('wind_speed', 'wind_speed')} FROM (
        SELECT event_id, ts AS timestamp, value AS temperature, value + 2 AS wind_speed FROM events
        UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, value + 1, value + 1 FROM events
        UNION ALL SELECT event_id, NULL, value + 2, value FROM events)""",
    "high_watermark": "SELECT event_type, max(ts) AS high_watermark FROM events GROUP BY 1",
    "lookback_window": "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 168 HOURS",
    "parse_ts": f"SELECT event_id, TRY_CAST({SQL_TEXT} AS TIMESTAMP) AS parsed FROM events",
    "resolve_timestamp": f"SELECT event_id, value, TRY_CAST({SQL_TEXT} AS TIMESTAMP) AS timestamp FROM events",
    # January: Copenhagen is one hour ahead of UTC.
    "local_to_utc": f"SELECT event_id, TRY_CAST({SQL_TEXT} AS TIMESTAMP) - INTERVAL 1 HOUR AS parsed FROM events",
    "field_map": "SELECT event_id, ts AS timestamp, value AS price, user_id AS energy_production FROM events",
    "ingest_meta": "SELECT event_id, 'events' AS data_source, 1 AS stamped FROM events",
    "price_heuristic": 'SELECT event_id, value AS price, value * 7 AS "SpotPriceDKK" FROM events',
    "production_heuristic": """SELECT event_id, ts AS timestamp, event_type || '-type' AS "ProductionType", value * 2 AS energy_production,
      value AS "SpotPriceEUR" FROM events""",
    "price_area_mean": f"""SELECT timestamp, {sql_round('price', 'price')} FROM (
      SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, avg(round(value * 100)) AS price FROM events GROUP BY 1)""",
    "production_sum": """SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp,
      coalesce(sum(CASE WHEN event_type = 'click' THEN round(value * 100) END), 0e0) AS energy_production FROM events GROUP BY 1""",
    "iso_format": f"SELECT event_id, {SQL_ISO} AS iso, strftime(ts, '%Y%m%dT%H%M%S') AS stamp FROM events",
    "asof_nearest": _asof_sql(
        _EVENTS.format(cols="event_id AS lid, value AS amount", kind="purchase"),
        _EVENTS.format(cols="event_id AS rid, value AS rval", kind="click"), "", 60,
        """timestamp, lid AS purchase_id, amount, CASE pick WHEN 1 THEN b_ts WHEN 2 THEN a_ts END AS click_at,
           CASE pick WHEN 1 THEN b_id WHEN 2 THEN a_id END AS click_id, CASE pick WHEN 1 THEN b_val WHEN 2 THEN a_val END AS click""",
    ),
    "asof_nearest_by_user": _asof_sql(
        _EVENTS.format(cols="user_id, event_id AS lid", kind="purchase"),
        _EVENTS.format(cols="user_id, event_id AS rid, 0 AS rval", kind="view"), "user_id", 1440,
        "user_id, timestamp, lid AS event_id, CASE pick WHEN 1 THEN b_id WHEN 2 THEN a_id END AS view_id",
    ),
    "join_inner_time": with_views(
        """SELECT h.timestamp, h.price, e.event_type AS "PriceArea", round(e.value * 100) AS cents
           FROM hourly h JOIN events e ON h.timestamp = date_trunc('hour', e.ts)""", "hourly"),
    "join_left_weather": with_views(
        """SELECT k.series, k.timestamp, k.price, o.n_orders FROM keyed k
           LEFT JOIN (SELECT o_orderdate, count(*) AS n_orders FROM orders GROUP BY 1) o ON k.timestamp = o.o_orderdate""", "keyed"),
    "composite_outer": """
      WITH s AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, event_type, max(value) AS v, count(*) AS n FROM events GROUP BY 1, 2),
      a AS (SELECT * FROM s WHERE event_type = 'click'), b AS (SELECT * FROM s WHERE event_type = 'view'), c AS (SELECT * FROM s WHERE event_type = 'purchase')
      SELECT timestamp, a.v AS price, coalesce(a.n, b.n, c.n) AS n, b.v AS temperature, c.v AS wind_speed
      FROM a FULL JOIN b USING (timestamp) FULL JOIN c USING (timestamp)""",
    "hourly_spine": with_views(
        "SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp FROM hourly", "hourly"),
    "daily_spine_keyed": with_views(f"+{SPINE} SELECT * FROM daily", "keyed"),
    "ffill_limited": with_views(f"+{SPINE} SELECT series, timestamp, {_FILL2} FROM daily", "keyed"),
    "null_ratio": with_views(
        f"+{SPINE}, r AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) AS null_ratio FROM daily"
            for c in ("series", "timestamp", *MEASURES))
        + f") SELECT column_name, {sql_round('null_ratio', 'null_ratio')}, null_ratio > 1e-1 AS above_threshold FROM r", "keyed"),
    "dup_timestamps": """SELECT l_suppkey, count(*) AS n_rows, count(*) - count(DISTINCT l_shipdate) AS n_duplicates
      FROM lineitem GROUP BY 1""",
    "ingest_batch": f"""
      WITH m AS (SELECT date_trunc('minute', ts)::TIMESTAMP AS timestamp, event_type, round(value * 100) AS cents FROM events),
      l AS (SELECT timestamp, timestamp AS lid, sum(cents / 4) AS energy_production FROM m WHERE event_type = 'purchase' GROUP BY 1),
      r AS (SELECT timestamp, avg(cents * 2) AS price FROM m WHERE event_type = 'click' GROUP BY 1),
      w AS (SELECT timestamp, max(cents / 1024) AS wind_speed, max(cents / 512 - 32) AS temperature FROM m WHERE event_type = 'view' GROUP BY 1),
      b AS (SELECT l.*, r.price AS b_val, r.timestamp AS b_ts FROM l ASOF LEFT JOIN r ON l.timestamp >= r.timestamp),
      a AS (SELECT l.lid AS a_lid, r.price AS a_val, r.timestamp AS a_ts FROM l ASOF LEFT JOIN r ON l.timestamp < r.timestamp),
      d AS (SELECT *, epoch_us(b.timestamp) - epoch_us(b_ts) AS back, epoch_us(a_ts) - epoch_us(b.timestamp) AS ahead FROM b JOIN a ON b.lid = a.a_lid),
      j AS (SELECT d.timestamp, energy_production, CASE WHEN back <= 3600000000 AND (ahead IS NULL OR back <= ahead) THEN b_val
                 WHEN ahead <= 3600000000 THEN a_val END AS price, wind_speed, temperature
            FROM d LEFT JOIN w ON d.timestamp = w.timestamp),
      f AS (SELECT timestamp, {_FILL_ALL} FROM j)
      SELECT timestamp, {', '.join(sql_round(c, c) for c in MEASURES)}, 'events' AS data_source, {REASON} AS reason FROM f""",
    "lake_roundtrip": with_views(f"SELECT {POINT_COLUMNS}, {PARTS} FROM points", "points"),
    "lake_pruned_scan": with_views(
        f"""SELECT {POINT_COLUMNS}, {PARTS} FROM points
            WHERE timestamp BETWEEN TIMESTAMP '2024-01-09 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'""", "points"),
    "quarantine": with_views(
        f"""SELECT reason, '2024-01-01T00:00:00' AS start_date, event_id, {sql_round('price', 'price')}
            FROM (SELECT *, {REASON} AS reason FROM points) WHERE reason IS NOT NULL""", "points"),
    "feature_store_write": with_views(
        """SELECT 'energy_features' AS feature_set_name, '2.0.0' AS version, count(*) AS n_samples, 14 AS n_features,
                  TIMESTAMP '2024-01-01' AS created_at FROM keyed""", "keyed"),
}

from tideshift.plans.feature_queries import ORACLE as _FEATURE_SQL  # noqa: E402

ORACLE["feature_store_latest"] = _FEATURE_SQL["roll_range"]
