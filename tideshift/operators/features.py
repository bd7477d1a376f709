"""Calendar and trailing-window features. Windows, lags and differences count rows, not hours."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideshift.functions.values import divide
from tideshift.operators.runs import HALO, MAX_ROWS, OrderedRuns, ordered_runs

# The four measures and the default windows, in rows.
MEASURES = ("wind_speed", "energy_production", "temperature", "price")
ROLLING = (1, 6, 24)
VOLATILITY = (6, 24)
RATES = (1, 6, 24)
DIFFERENCES = (1, 6)
LAGS = (1, 6, 12, 24)
EPSILON = 1e-6
PIECES = 4  # a wider window is put together from at most so many equal ones and a rest

FILLED = "__filled_"


# ---- calendar ---------------------------------------------------------------------------------


def calendar_parts(ts: str = "timestamp") -> dict[str, Column]:
    """Hour, weekday with Monday as 0, day of year and weekend flag."""
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "day_of_year": F.dayofyear(ts),
        "is_weekend": (weekday >= 5).cast("int"),
    }


def cyclic_parts(ts: str = "timestamp") -> dict[str, Column]:
    """Hour of day and day of week as points on a circle."""
    day = F.hour(ts) * (2 * F.pi() / 24)
    week = F.weekday(ts) * (2 * F.pi() / 7)
    return {"hour_sin": F.sin(day), "hour_cos": F.cos(day), "day_sin": F.sin(week), "day_cos": F.cos(week)}


def add_calendar(df: DataFrame, ts: str = "timestamp", parts: bool = True, cyclic: bool = True) -> DataFrame:
    return df.withColumns((calendar_parts(ts) if parts else {}) | (cyclic_parts(ts) if cyclic else {}))


# ---- window expressions -----------------------------------------------------------------------


class Trailing:
    """Column expressions over the trailing rows of a series.

    Each distinct window aggregate is evaluated once, under a name in ``base``; the returned
    expressions refer to those names. ``needs`` collects what must hold for all of them to have a value
    in a row whose own measures are complete.

    Spark adds up every row of a sliding frame anew for each row. Deviations therefore come from moments
    (count, mean, squared deviations) that are merged: a window is made of a few shorter ones that end in
    earlier rows, which ``lag`` finds. ``steps`` holds what these need, to be added before ``base``.
    """

    def __init__(self, runs: OrderedRuns):
        self.window = runs.window
        self.base: dict[str, Column] = {}
        self.needs: dict[tuple, Column] = {}
        self._levels: dict[tuple[str, int], int] = {}  # windows with moments, and on how many others they rest
        self._made: dict[tuple[int, int], dict[str, Column]] = {}  # by level and place in it

    @property
    def steps(self) -> list[dict[str, Column]]:
        """Columns that ``base`` refers to, in the order in which they are to be added."""
        return [self._made[at] for at in sorted(self._made)]

    def _shared(self, label: str, c: str, rows: int, expression: Column) -> Column:
        name = f"__{label}_{c}_{rows}"
        self.base.setdefault(name, expression)
        return F.col(name)

    def _over(self, aggregate, c: str, rows: int) -> Column:
        frame = self.window.rowsBetween(-(rows - 1), 0)
        return self._shared(aggregate.__name__, c, rows, aggregate(c).over(frame))

    def _moments(self, c: str, rows: int, back: int = 0) -> list[str]:
        """Names of the count, mean and squared deviations of the window that ends ``back`` rows earlier."""
        return [f"__{m}_{c}_{rows}" + (f"_{back}" if back else "") for m in ("n", "mean", "m2")]

    def _merge(self, c: str, rows: int) -> int:
        """Have the moments of a window made, zeros if it is empty; returns its level."""
        if (c, rows) in self._levels:
            return self._levels[c, rows]
        own = self._moments(c, rows)
        if rows == 1:
            x = F.col(c).cast("double")
            # 0 * x hands infinity and NaN on: a window with one of them has the deviation NaN.
            value = [x.isNotNull().cast("double"), F.coalesce(x, F.lit(0.0)), F.coalesce(0 * x, F.lit(0.0))]
            self._made.setdefault((0, 0), {}).update(zip(own, value))
            return self._levels.setdefault((c, rows), 0)
        made = [w for name, w in self._levels if name == c and w < rows <= PIECES * w]
        piece = max(made, default=-(-rows // PIECES))
        parts = [(piece, back) for back in range(0, rows - piece + 1, piece)]
        if rows % piece:
            parts.append((rows % piece, rows - rows % piece))
        level = 1 + max(self._merge(c, w) for w, _ in parts)
        lags = self._made.setdefault((level, 0), {})
        n, mean, m2 = map(F.col, self._moments(c, piece))
        for i, (w, back) in enumerate(parts[1:], 1):
            earlier = self._moments(c, w, back)
            lags |= {then: F.lag(now, back, 0.0).over(self.window) for now, then in zip(self._moments(c, w), earlier)}
            n_e, mean_e, m2_e = map(F.col, earlier)
            share, apart = n_e / F.greatest(n + n_e, F.lit(1.0)), mean_e - mean
            both = own if i == len(parts) - 1 else [f"{name}_of_{i}" for name in own]
            merged = [n + n_e, mean + apart * share, m2 + m2_e + apart * apart * (n * share)]
            self._made.setdefault((level, i), {}).update(zip(both, merged))
            n, mean, m2 = map(F.col, both)
        return self._levels.setdefault((c, rows), level)

    # A window of one row is the row itself, so no frame is evaluated for it.
    def mean(self, c: str, rows: int) -> Column:
        return F.col(c) if rows == 1 else self._over(F.avg, c, rows)

    def std(self, c: str, rows: int) -> Column:
        if rows == 1:
            return F.when(F.col(c).isNotNull(), F.lit(0.0))
        self._merge(c, rows)
        n, _, m2 = map(F.col, self._moments(c, rows))
        # A lag of no rows: the window evaluates this by itself, so the merges and what is done with the
        # deviations are not fused into one method too large to be compiled.
        std = self._shared("std", c, rows, F.lag(F.when(n > 0, F.sqrt(m2 / n)), 0).over(self.window))
        self.needs["std", c, rows] = ~F.isnan(std)  # an infinite measure makes its windows' deviation NaN
        return std

    def min(self, c: str, rows: int) -> Column:
        return F.col(c) if rows == 1 else self._over(F.min, c, rows)

    def max(self, c: str, rows: int) -> Column:
        return F.col(c) if rows == 1 else self._over(F.max, c, rows)

    def variation(self, c: str, rows: int) -> Column:
        std, shifted = self.std(c, rows), self.mean(c, rows) + EPSILON
        self.needs["variation", c, rows] = (std != 0) | (shifted != 0)
        return divide(std, shifted)

    def spread(self, c: str, rows: int) -> Column:
        return self.max(c, rows) - self.min(c, rows)

    def lag(self, c: str, rows: int) -> Column:
        lag = self._shared("lag", c, rows, F.lag(c, rows).over(self.window))
        self.needs["lag", c, rows] = lag.isNotNull()
        return lag

    def difference(self, c: str, rows: int) -> Column:
        return F.col(c) - self.lag(c, rows)

    def rate(self, c: str, rows: int) -> Column:
        """Relative change against ``rows`` earlier, both sides taken from the filled column."""
        filled = FILLED + c
        now, then = F.col(filled), self.lag(filled, rows)
        self.needs["rate", c, rows] = (now != 0) | (then != 0)
        return divide(now, then) - 1


def rolling_features(t: Trailing, columns: Sequence[str], windows: Sequence[int] = ROLLING) -> dict[str, Column]:
    out = {}
    for c in columns:
        for w in windows:
            out[f"{c}_ma_{w}h"] = t.mean(c, w)
            out[f"{c}_std_{w}h"] = t.std(c, w)
            out[f"{c}_min_{w}h"] = t.min(c, w)
            out[f"{c}_max_{w}h"] = t.max(c, w)
    return out


def volatility_features(t: Trailing, columns: Sequence[str], windows: Sequence[int] = VOLATILITY) -> dict[str, Column]:
    out = {}
    for c in columns:
        for w in windows:
            out[f"{c}_cv_{w}h"] = t.variation(c, w)
            out[f"{c}_range_{w}h"] = t.spread(c, w)
    return out


def trend_features(t: Trailing, columns: Sequence[str]) -> dict[str, Column]:
    out = {}
    for c in columns:
        out |= {f"{c}_roc_{k}h": t.rate(c, k) for k in RATES}
        out |= {f"{c}_diff_{k}h": t.difference(c, k) for k in DIFFERENCES}
    return out


def lag_features(t: Trailing, columns: Sequence[str], lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"{c}_lag_{k}h": t.lag(c, k) for c in columns for k in lags}


# ---- operators --------------------------------------------------------------------------------


def windowed(
    df: DataFrame,
    build,
    lookback: int,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    filled: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
    complete: bool = False,
) -> DataFrame:
    """Add the columns ``build(Trailing)`` returns; they may look back ``lookback`` rows.

    ``filled`` columns are forward-filled without limit first and offered as ``__filled_{name}``.
    ``complete`` keeps only rows without a missing value. It is tested on the window aggregates: testing
    the hundred finished columns would repeat their expressions in one method too large to be compiled.
    """
    runs = ordered_runs(df, keys, (ts, *tie), max_rows)
    if filled:
        runs = runs.replace(runs.last_known({c: FILLED + c for c in filled}))
    runs = runs.with_halo(lookback)
    trailing = Trailing(runs)
    added = build(trailing)
    stepped = reduce(DataFrame.withColumns, trailing.steps, runs.df)
    based = stepped.select("*", *[c.alias(n) for n, c in trailing.base.items()]).where(~F.col(HALO))
    if complete:
        based = based.dropna("any", subset=df.columns).where(reduce(and_, trailing.needs.values(), F.lit(True)))
    return based.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def window_columns(
    df: DataFrame,
    kind: str,
    columns: Sequence[str] = MEASURES,
    windows: Sequence[int] | None = None,
    **layout,
) -> DataFrame:
    """One family of window features by name.

    ``kind``: mean, std, min, max, variation, spread (trailing windows), rate, difference, lag (rows back).
    """
    names = {
        "mean": ("ma", ROLLING),
        "std": ("std", ROLLING),
        "min": ("min", ROLLING),
        "max": ("max", ROLLING),
        "variation": ("cv", VOLATILITY),
        "spread": ("range", VOLATILITY),
        "rate": ("roc", RATES),
        "difference": ("diff", DIFFERENCES),
        "lag": ("lag", LAGS),
    }
    label, default = names[kind]
    spans = tuple(windows or default)

    def build(t: Trailing) -> dict[str, Column]:
        return {f"{c}_{label}_{w}h": getattr(t, kind)(c, w) for c in columns for w in spans}

    return windowed(df, build, max(spans), filled=columns if kind == "rate" else (), **layout)


def engineer_features(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    columns: Sequence[str] = MEASURES,
    rolling: Sequence[int] = ROLLING,
    volatility: Sequence[int] = VOLATILITY,
    dropna: bool = True,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """All features of each row: 8 calendar and, with default windows, 100 window columns.

    All windows share one partitioning and order, so the whole table costs one exchange and one sort.
    ``dropna`` drops rows with any missing value; infinity stays.
    """

    def build(t: Trailing) -> dict[str, Column]:
        return (
            calendar_parts(ts)
            | cyclic_parts(ts)
            | rolling_features(t, columns, rolling)
            | volatility_features(t, columns, volatility)
            | trend_features(t, columns)
            | lag_features(t, columns)
        )

    lookback = max([*rolling, *volatility, *RATES, *DIFFERENCES, *LAGS])
    return windowed(df, build, lookback, keys, ts, tie, filled=columns, max_rows=max_rows, complete=dropna)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any (given) column."""
    return df.dropna("any", subset=list(columns) if columns else None)


def feature_names(
    columns: Sequence[str],
    exclude: Sequence[str] = ("timestamp", "ingestion_timestamp", "data_source", "energy_production", "regime"),
    target: str = "energy_production",
    exclude_target_derived: bool = False,
) -> list[str]:
    """Model inputs among ``columns``. The windows of one row over the target equal the target itself;
    ``exclude_target_derived`` leaves everything derived from the target out."""
    derived = f"{target}_"
    return [
        c for c in columns if c not in exclude and not (exclude_target_derived and c.startswith(derived))
    ]


def single_point_features(
    df: DataFrame, ts: str = "timestamp", columns: Sequence[str] = MEASURES
) -> DataFrame:
    """Features of rows scored alone: without history every window collapses to a closed form.

    Mean, min and max are the value, spread measures 0, and what needs a past is filled with 0, so this
    is a plain projection. A missing measure counts as 0.
    """
    zero = F.lit(0.0)
    out = calendar_parts(ts) | cyclic_parts(ts)
    for c in columns:
        value = F.coalesce(F.nanvl(F.col(c), zero), zero)
        for w in ROLLING:
            out |= {f"{c}_ma_{w}h": value, f"{c}_std_{w}h": zero, f"{c}_min_{w}h": value, f"{c}_max_{w}h": value}
    for c in columns:
        for w in VOLATILITY:
            out |= {f"{c}_cv_{w}h": zero, f"{c}_range_{w}h": zero}
    for c in columns:
        out |= {f"{c}_roc_{k}h": zero for k in RATES} | {f"{c}_diff_{k}h": zero for k in DIFFERENCES}
    for c in columns:
        out |= {f"{c}_lag_{k}h": zero for k in LAGS}
    return df.select("*", *[v.alias(n) for n, v in out.items()])
