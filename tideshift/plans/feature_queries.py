"""Calendar and window features over the keyed and the single series."""

from __future__ import annotations

from tideshift.operators import features as fe
from tideshift.plans.views import hourly, keyed, points, rounded, sql_round, with_views

# One row per series and day, so a series has a few thousand rows at any scale and needs no size check.
KEY = {"keys": ("series",), "max_rows": None}
W = "(PARTITION BY series ORDER BY timestamp{frame})"


def _over(expression: str, rows: int | None = None) -> str:
    frame = f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW" if rows else ""
    return f"{expression} OVER {W.format(frame=frame)}"


def _term(kind: str, c: str, w: int) -> str:
    std, mean = _over(f"stddev_pop({c})", w), _over(f"avg({c})", w)
    low, high = _over(f"min({c})", w), _over(f"max({c})", w)
    lag = _over(f"lag({c}, {w})")
    return {
        "mean": mean,
        "std": std,
        "min": low,
        "max": high,
        "variation": f"({std}) / ({mean} + 1e-6)",
        "spread": f"({high}) - ({low})",
        "lag": lag,
        "difference": f"{c} - {lag}",
        "rate": f"f_{c} / {_over(f'lag(f_{c}, {w})')} - 1",
    }[kind]


LABELS = {
    "mean": ("ma", fe.ROLLING), "std": ("std", fe.ROLLING), "min": ("min", fe.ROLLING), "max": ("max", fe.ROLLING),
    "variation": ("cv", fe.VOLATILITY), "spread": ("range", fe.VOLATILITY), "rate": ("roc", fe.RATES),
    "difference": ("diff", fe.DIFFERENCES), "lag": ("lag", fe.LAGS),
}

FILLED = ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY timestamp "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f_{c}"
    for c in fe.MEASURES
)


def _terms(kinds) -> list[tuple[str, str]]:
    return [
        (f"{c}_{LABELS[k][0]}_{w}h", _term(k, c, w)) for k in kinds for c in fe.MEASURES for w in LABELS[k][1]
    ]


def _windows_sql(source: str, kinds, calendar: bool = False, dropna: bool = False) -> str:
    terms = _terms(kinds)
    key = "series, " if source == "keyed" else ""
    base = "series" if source == "keyed" else "0 AS series"
    extra = f", {CALENDAR}, {CYCLIC}" if calendar else ""
    names = [n for n, _ in terms] + ["hour_sin", "hour_cos", "day_sin", "day_cos"] * calendar
    plain = [*fe.MEASURES] + ["hour", "day_of_week", "day_of_year", "is_weekend"] * calendar
    keep = (
        "WHERE " + " AND ".join(f"{n} IS NOT NULL AND NOT isnan({n})" for n, _ in terms) if dropna else ""
    )
    body = f"""+ base AS (SELECT {base}, timestamp, {', '.join(fe.MEASURES)} FROM {source}),
      filled AS (SELECT *, {FILLED} FROM base),
      made AS (SELECT *, {', '.join(f'{t} AS {n}' for n, t in terms)}{extra} FROM filled)
    SELECT {key}timestamp, {', '.join(plain)}, {', '.join(sql_round(n, n) for n in names)} FROM made {keep}"""
    return with_views(body, source)


CALENDAR = (
    "CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, "
    "CAST(dayofyear(timestamp) AS INTEGER) AS day_of_year, "
    "CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend"
)
CYCLIC = (
    "sin(hour(timestamp) * (2 * pi() / 24)) AS hour_sin, cos(hour(timestamp) * (2 * pi() / 24)) AS hour_cos, "
    "sin((isodow(timestamp) - 1) * (2 * pi() / 7)) AS day_sin, cos((isodow(timestamp) - 1) * (2 * pi() / 7)) AS day_cos"
)


def _family(kind):
    return lambda spark, sf: rounded(fe.window_columns(keyed(spark, sf), kind, **KEY))


NAMES = {
    "roll_mean": "mean", "roll_std": "std", "roll_min": "min", "roll_max": "max", "roll_cv": "variation",
    "roll_range": "spread", "rate_of_change": "rate", "diff": "difference", "lags": "lag",
}
ALL = ("mean", "std", "min", "max", "variation", "spread", "rate", "difference", "lag")

QUERIES = {name: _family(kind) for name, kind in NAMES.items()}
ORACLE = {name: _windows_sql("keyed", [kind]) for name, kind in NAMES.items()}

QUERIES |= {
    "feature_table": lambda spark, sf: rounded(fe.engineer_features(hourly(spark, sf), max_rows=None)),
    "feature_table_keyed": lambda spark, sf: rounded(fe.engineer_features(keyed(spark, sf), **KEY)),
    "temporal_parts": lambda spark, sf: fe.add_calendar(
        points(spark, sf).select("event_id", "timestamp"), cyclic=False
    ),
    "cyclical": lambda spark, sf: rounded(
        fe.add_calendar(points(spark, sf).select("event_id", "timestamp"), parts=False)
    ),
    "point_features": lambda spark, sf: rounded(
        fe.single_point_features(points(spark, sf).drop("user_id", "event_type"))
    ),
    "drop_incomplete": lambda spark, sf: rounded(
        fe.drop_incomplete(fe.window_columns(keyed(spark, sf), "lag", **KEY))
    ),
}


def _point_sql() -> str:
    value = {
        **{k: "{c}" for k in ("mean", "min", "max")},
        **{k: "0e0" for k in ("std", "variation", "spread", "rate", "difference", "lag")},
    }
    terms = [
        sql_round(value[k].format(c=c), f"{c}_{LABELS[k][0]}_{w}h")
        for k in ALL for c in fe.MEASURES for w in LABELS[k][1]
    ]
    cyc = ", ".join(sql_round(n, n) for n in ("hour_sin", "hour_cos", "day_sin", "day_cos"))
    own = ", ".join(sql_round(c, c) for c in fe.MEASURES)
    return with_views(
        f"+ made AS (SELECT *, {CALENDAR}, {CYCLIC} FROM points) SELECT event_id, timestamp, {own}, hour, day_of_week, "
        f"day_of_year, is_weekend, {cyc}, {', '.join(terms)} FROM made",
        "points",
    )


ORACLE |= {
    "feature_table": _windows_sql("hourly", ALL, calendar=True, dropna=True),
    "feature_table_keyed": _windows_sql("keyed", ALL, calendar=True, dropna=True),
    "temporal_parts": with_views(f"SELECT event_id, timestamp, {CALENDAR} FROM points", "points"),
    "cyclical": with_views(
        f"+ made AS (SELECT event_id, timestamp, {CYCLIC} FROM points) SELECT event_id, timestamp, "
        + ", ".join(sql_round(n, n) for n in ("hour_sin", "hour_cos", "day_sin", "day_cos"))
        + " FROM made",
        "points",
    ),
    "point_features": _point_sql(),
    "drop_incomplete": _windows_sql("keyed", ["lag"], dropna=True),
}
