"""Change points of a signal by penalised segment cost with a Gaussian kernel."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.operators.regimes import label_segments, one_hot, regime_name
from tideshift.operators.runs import MAX_ROWS
from tideshift.session import settle, shuffle_partitions

# Defaults of the search and the bounds of the scaled squared distances.
PENALTY = 10.0
MIN_SIZE = 24
STEP = 5
DISTANCE_BOUNDS = (1e-2, 1e2)
QUANTILES = 256  # steps of the quantiles that stand for a series' values when its bandwidth is taken
ACCURACY = 10_000
PIECE = 64  # values that the search takes in at a time
PIECE_VALUES = 65_536  # entries of a piece's kernel table, as long as a single value needs fewer


def bandwidth(quantiles: np.ndarray) -> float:
    """The median squared distance between the quantiles of a series; 1 if they are all equal."""
    d = (quantiles[:, None] - quantiles[None, :]) ** 2
    middle = float(np.median(d[np.triu_indices(len(quantiles), 1)]))
    return middle if middle > 0 else 1.0


class Search:
    """The cheapest segmentation of a series that arrives piece by piece.

    A segment costs its scatter in the kernel's feature space plus the penalty, and ends lie on a grid of ``step``. A start
    is dropped once it cannot win any more, and so are the values before the oldest start left: what is kept is the
    values and starts that can still matter, and one number for each end for the way back. Nothing depends on
    how the series was cut.
    """

    def __init__(self, width: float, penalty: float = PENALTY, min_size: int = MIN_SIZE, step: int = STEP):
        self.width, self.penalty, self.min_size, self.step = width, penalty, min_size, step
        self.n = 0
        self.oldest = 0  # place of the first value kept
        self.needed = 0  # place of the first value that can still matter
        self.values = np.zeros(256)
        self.inner = np.zeros(0)  # kernel sums of [start, n) for the grid places from the oldest on
        self.best = [0.0]  # by grid place; infinite where no segment can end
        self.previous = [0]
        self.open = 0  # starts that can still win
        self.starts = np.zeros(64, np.int64)
        self.paid = np.zeros(64)  # best costs at the starts

    def feed(self, x: np.ndarray) -> None:
        x, at = np.asarray(x, dtype=float), 0
        while at < len(x):
            size = min(PIECE, max(PIECE_VALUES // (self.n - self.oldest + 1), 1))
            self._add(x[at : at + size])
            at += size

    def _add(self, x: np.ndarray) -> None:
        """Take a piece in: one kernel table of what is kept and the piece, added up by grid places."""
        kept, size = self.n - self.oldest, len(x)
        while kept + size > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(len(self.values))])
        self.values[kept : kept + size] = x
        k = self.values[: kept + size, None] - x
        np.multiply(k, k, out=k)
        k /= -self.width
        np.clip(k, -DISTANCE_BOUNDS[1], -DISTANCE_BOUNDS[0], out=k)
        np.exp(k, out=k)
        k[kept:] = np.triu(k[kept:], 1)  # a value pairs with those before it
        # The oldest value lies on the grid, and so every step-th one from it.
        places = np.arange(0, kept + size, self.step)
        pairs = np.add.reduceat(k, places, axis=0)[::-1].cumsum(0)[::-1]
        inner = 2 * pairs + (places[:, None] <= np.arange(kept, kept + size))
        known = -(-kept // self.step)
        inner[:known, 0] += self.inner[:known]
        inner = inner.cumsum(1)
        before = self.n
        for n in range((before // self.step + 1) * self.step, before + size + 1, self.step):
            self.inner, self.n = inner[:, n - before - 1], n
            self._end(n)
        self.inner, self.n = inner[:, -1].copy(), before + size
        self._forget(self.needed)

    def _end(self, end: int, last: bool = False) -> float:
        newest = (end - self.min_size) // self.step * self.step
        if newest >= 0 and self.best[newest // self.step] < np.inf and (not self.open or newest > self.starts[self.open - 1]):
            if self.open == len(self.starts):
                self.starts, self.paid = np.resize(self.starts, 2 * self.open), np.resize(self.paid, 2 * self.open)
            self.starts[self.open], self.paid[self.open] = newest, self.best[newest // self.step]
            self.open += 1
        cost, previous = np.inf, 0
        if end >= self.min_size and self.open:
            starts, paid = self.starts[: self.open], self.paid[: self.open]
            size = end - starts
            costs = paid + size - self.inner[(starts - self.oldest) // self.step] / size + self.penalty
            pick = int(costs.argmin())
            cost, previous = float(costs[pick]), int(starts[pick])
            if not last and not costs.max() <= cost + self.penalty:
                stay = np.flatnonzero(costs <= cost + self.penalty)
                self.open = len(stay)
                self.starts[: self.open], self.paid[: self.open] = starts[stay], paid[stay]
        if last:
            return previous
        self.best.append(cost)
        self.previous.append(previous)
        self.needed = max(newest + self.step, 0)
        if self.open:
            self.needed = min(self.needed, int(self.starts[0]))
        return previous

    def _forget(self, oldest: int) -> None:
        """Drop what lies before the oldest start, once that is the larger part of what is kept."""
        gone = oldest - self.oldest
        if gone > 64 and 2 * gone > self.n - self.oldest:
            self.values = self.values[gone:].copy()
            self.inner = self.inner[gone // self.step :].copy()
            self.oldest = oldest

    def ends(self) -> list[int]:
        """Ends of the segments of all that arrived, the last one being its length."""
        if self.n < 2 * self.min_size:
            return [self.n] if self.n else []
        at = self.previous[self.n // self.step] if self.n % self.step == 0 else int(self._end(self.n, last=True))
        found = [self.n]
        while at > 0:
            found.append(at)
            at = self.previous[at // self.step]
        return found[::-1]


def pelt(x: np.ndarray, penalty: float = PENALTY, min_size: int = MIN_SIZE, step: int = STEP) -> list[int]:
    """Ends of the cheapest segmentation of one array."""
    x = np.asarray(x, dtype=float)
    if not len(x):
        return []
    at = np.ceil(np.arange(QUANTILES + 1) / QUANTILES * len(x)).astype(int) - 1
    search = Search(bandwidth(np.sort(x)[np.maximum(at, 0)]), penalty, min_size, step)
    search.feed(x)
    return search.ends()


def change_points(
    df: DataFrame,
    signal: str,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    penalty: float = PENALTY,
    min_size: int = MIN_SIZE,
    step: int = STEP,
) -> DataFrame:
    """Exclusive end positions of the segments of each series, the last one being its length.

    One search serves every length: the bandwidth of a series comes from its quantiles (a sketch of bounded size, exact
    up to ``ACCURACY`` rows), and its rows then stream through one task in order, which keeps only what can still matter.
    Time grows with the length times the reach of a segment; a series without any change is quadratic in time.
    A missing value counts as the last known one, or 0 before the first.
    """
    keys = list(keys)
    place = (ts, *tie)
    rows = df.select(*keys, *place, F.nanvl(F.col(signal).cast("double"), F.lit(None)).alias("__x"))
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    known = rows.select(*keys, F.coalesce("__x", F.lit(0.0)).alias("__x"))
    heads = known.groupBy(*keys).agg(F.percentile_approx("__x", shares, ACCURACY).alias("__q"))
    # The quantiles of a series come first among its rows.
    stream = rows.withColumn("__body", F.lit(1)).unionByName(
        heads.withColumn("__body", F.lit(0)), allowMissingColumns=True
    )
    parts = shuffle_partitions(df.sparkSession)
    dealt = stream.repartition(parts, *keys) if keys else stream.repartition(1)
    dealt = dealt.sortWithinPartitions(*keys, "__body", *place).select(*keys, "__body", "__x", "__q")
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("segment_end", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search, own, last = None, None, 0.0

        def results(found: list[tuple]) -> pd.DataFrame:
            sizes = [len(ends) for _, ends in found]
            made = {k: [names[i] for (names, _), n in zip(found, sizes) for _ in range(n)] for i, k in enumerate(keys)}
            return pd.DataFrame(made | {"segment_end": np.array([e for _, ends in found for e in ends], np.int64)})

        for frame in frames:
            done = []
            heads = set(np.flatnonzero(frame["__body"].to_numpy() == 0).tolist())
            cuts = [0, *sorted(heads), len(frame)]
            known = frame["__x"].to_numpy(float)
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if a in heads:
                    if search is not None:
                        done.append((own, search.ends()))
                    own = [frame[k].iloc[a] for k in keys]
                    search, last = Search(bandwidth(np.asarray(frame["__q"].iloc[a], float)), penalty, min_size, step), 0.0
                    a += 1
                if a < b:
                    x = known[a:b]
                    if np.isnan(x).any():
                        x = pd.Series(x).ffill().fillna(last).to_numpy(float)
                    search.feed(x)
                    last = float(x[-1])
            if done:
                yield results(done)
        if search is not None:
            yield results([(own, search.ends())])

    return dealt.mapInPandas(run, schema)


def attach_change_point_regimes(
    df: DataFrame,
    signal: str,
    n_regimes: int = 3,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    breakpoints: DataFrame | None = None,
    max_rows: int | None = MAX_ROWS,
    **search,
) -> DataFrame:
    """Rows plus regime, certain probabilities and name. Stored ``breakpoints`` are used if given."""
    ends = breakpoints
    if ends is None:
        ends = settle(change_points(df, signal, keys, ts, tie, **search))
    labelled = label_segments(df, ends, signal, n_regimes, keys, (ts, *tie), max_rows)
    return one_hot(labelled.drop("position", "segment"), "regime_id", n_regimes).withColumn(
        "regime_name", regime_name(F.col("regime_id"))
    )
