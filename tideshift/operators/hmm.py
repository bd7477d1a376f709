"""Hidden Markov regimes with diagonal Gaussian emissions, for many series or one very long one.

Rows are packed once into blocks of bounded length and stored; every pass over them is then a narrow
``mapInPandas``. Within a block, all blocks of a batch advance together. A series longer than a block is
stitched exactly: a block's effect on the state weights is a small matrix, and the products of these
matrices along the series give what enters each block from the left and from the right.

A fit whose blocks fit into the memory of the tasks runs its rounds inside one barrier stage: the tasks keep their blocks, exchange
sums of a few hundred bytes after each round and all make the same next model. Otherwise each round is a job.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.operators.regimes import regime_name
from tideshift.operators.runs import MAX_ROWS, join_keys, ordered_runs
from tideshift.session import settle

# Defaults of the fit.
REGIMES = 3
ITERATIONS = 200
TOLERANCE = 1e-2
SEED = 42
VARIANCE_PRIOR = 1e-2
VARIANCE_FLOOR = 1e-3

SMALLEST = 1e-200  # scaled weights below this are computed in logarithms
BLOCK_ROWS = 4096
FAN = 4096
BATCH_VALUES = 1_000_000
BROADCAST_BLOCKS = 200_000
STAGE_BLOCK_ROWS = 256  # short blocks, for few series: a task advances many side by side
STAGE_LANES = 64  # blocks for each slot from which on series stay as long as they are, and need no stitching
TASK_VALUES = 4_000_000  # feature values that one task of a barrier stage keeps (32 MB, twice that while it takes them in)
STAGE_ROUNDS = 50  # rounds of one barrier stage; a lost executor costs these at most


@dataclass(frozen=True)
class HmmModel:
    columns: tuple[str, ...]
    start: np.ndarray
    transitions: np.ndarray
    means: np.ndarray
    variances: np.ndarray
    log_likelihood: float = float("nan")
    trace: tuple[float, ...] = ()

    @property
    def n_regimes(self) -> int:
        return len(self.start)


@dataclass(frozen=True)
class Blocks:
    """Packed series: one row per block with its rows' places and a flat array of features."""

    df: DataFrame
    keys: tuple[str, ...]
    place: tuple[str, ...]
    columns: tuple[str, ...]
    longest: int
    stitched: int
    count: int = 0
    values: int = 0  # feature values in all blocks


def pack(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    max_rows: int | None = MAX_ROWS,
) -> Blocks:
    """Pack complete rows into blocks of ``block_rows`` and store them. Incomplete rows take no part."""
    keys, place = tuple(keys), (ts, *tie)
    features = F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.dropna("any", subset=list(columns)).select(*keys, *place, features.alias("__x"))
    runs = ordered_runs(rows, keys, place, max_rows)
    numbered = runs.numbered("__n", total="__rows")
    block = F.floor((F.col("__n") - 1) / block_rows)
    # Whole series already lie together, and grouping within them needs no further exchange.
    group = keys if runs.split else runs.group
    gathered = numbered.groupBy(*group, block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("__n", F.struct(*place).alias("place"), "__x"))).alias("__rows_in"),
        F.ceil(F.first("__rows") / block_rows).alias("n_blocks"),
    )
    packed = settle(
        gathered.select(
            *keys,
            "block",
            "n_blocks",
            F.transform("__rows_in", lambda r: r["place"]).alias("places"),
            F.flatten(F.transform("__rows_in", lambda r: r["__x"])).alias("xs"),
        )
    )
    long_ones = F.count_if(F.col("n_blocks") > 1)
    sizes = packed.agg(F.max("n_blocks"), long_ones, F.count(F.lit(1)), F.sum(F.size("xs").cast("long"))).collect()[0]
    return Blocks(packed, keys, place, tuple(columns), *(int(x or 0) for x in sizes))


# ---- arithmetic on a batch of blocks ----------------------------------------------------------


def _batches(frames: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Blocks of similar length as padded arrays ``(block, row, column)`` with their lengths."""
    for frame in frames:
        lengths = frame["xs"].map(len).to_numpy() // width
        order = np.argsort(lengths, kind="stable")
        while len(order):
            longest = max(1, BATCH_VALUES // (max(1, lengths[order[-1]]) * width))
            take, order = order[-longest:], order[:-longest]
            n = lengths[take]
            x = np.zeros((len(take), n.max(), width))
            for lane, i in enumerate(take):
                x[lane, : n[lane]] = np.asarray(frame["xs"].iloc[i]).reshape(-1, width)
            yield frame.iloc[take].reset_index(drop=True), x, n


def _log_density(x: np.ndarray, model: HmmModel) -> np.ndarray:
    out = np.empty((*x.shape[:2], model.n_regimes))
    for k in range(model.n_regimes):
        v, apart = model.variances[k], x - model.means[k]
        out[..., k] = -0.5 * ((apart * apart) @ (1 / v) + np.log(2 * np.pi * v).sum())
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of the sum of exponentials along an axis; all of zero weight stays at minus infinity."""
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def _logs(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


def _heads(frame: pd.DataFrame, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weights that enter each block, and which blocks start their series."""
    starts = (frame["block"] == 0).to_numpy()
    heads = np.tile(first, (len(frame), 1))
    if "head" in frame:
        for i in np.flatnonzero(~starts):
            heads[i] = frame["head"].iloc[i]
    return heads, starts


def _forward(density: np.ndarray, n: np.ndarray, heads: np.ndarray, starts: np.ndarray, a: np.ndarray):
    """Scaled state weights per row, the log scale per block and the per-row densities up to a factor."""
    top = density.max(-1, keepdims=True)
    b = np.exp(density - top)
    alpha = np.empty_like(b)
    now = np.where(starts[:, None], heads, heads @ a) * b[:, 0]
    scales = np.empty(b.shape[:2])
    for s in range(b.shape[1]):
        if s:
            now = (now @ a) * b[:, s]
        scale = now.sum(-1)
        now = now / scale[:, None]
        alpha[:, s] = now
        scales[:, s] = scale
    inside = np.arange(b.shape[1]) < n[:, None]
    return alpha, np.where(inside, np.log(scales) + top[..., 0], 0.0).sum(1), b


def _backward(b: np.ndarray, n: np.ndarray, tails: np.ndarray, a: np.ndarray) -> np.ndarray:
    beta = np.empty_like(b)
    now = tails.copy()
    for s in range(b.shape[1] - 1, -1, -1):
        if s + 1 < b.shape[1]:
            inner = (b[:, s + 1] * now) @ a.T
            inner /= inner.sum(-1, keepdims=True)
            now = np.where((s + 1 < n)[:, None], inner, tails)
        beta[:, s] = now
    return beta


def _tails(frame: pd.DataFrame, k: int) -> np.ndarray:
    """Log weights of what follows each block."""
    tails = np.zeros((len(frame), k))
    if "tail" in frame:
        for i, t in enumerate(frame["tail"]):
            if t is not None:
                tails[i] = t
    return tails


def _unit(log_weights: np.ndarray) -> np.ndarray:
    return np.exp(log_weights - _lse(log_weights, -1)[..., None])


def _weak(weights: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Lanes in which a scaled weight came near the end of the number range, or left it."""
    return ~(np.where(inside, weights.min(-1), 1.0).min(1) > SMALLEST)


def _in_logs(density, n, heads, starts, tails, log_a):
    """Forward and backward log weights per row, and the log likelihood of each block; slower, and never out of range."""
    steps = density.shape[1]
    la, lb = np.empty_like(density), np.empty_like(density)
    heads = heads - _lse(heads, -1)[:, None]
    la[:, 0] = np.where(starts[:, None], heads, _lse(heads[:, :, None] + log_a, 1)) + density[:, 0]
    for s in range(1, steps):
        la[:, s] = _lse(la[:, s - 1, :, None] + log_a, 1) + density[:, s]
    now = tails
    for s in range(steps - 1, -1, -1):
        if s + 1 < steps:
            inner = _lse(log_a[None] + (density[:, s + 1] + now)[:, None, :], 2)
            now = np.where((s + 1 < n)[:, None], inner, tails)
        lb[:, s] = now
    return la, lb, _lse(la[np.arange(len(n)), n - 1], -1)


def _log_likelihoods(density, n, heads, starts, a) -> np.ndarray:
    alpha, log_like, _ = _forward(density, n, _unit(heads), starts, a)
    weak = _weak(alpha, np.arange(density.shape[1]) < n[:, None])
    if weak.any():
        none = np.zeros((int(weak.sum()), a.shape[0]))
        log_like[weak] = _in_logs(density[weak], n[weak], heads[weak], starts[weak], none, _logs(a))[2]
    return log_like


def _smooth(density, n, heads, starts, tails, a):
    """Weights per row given the whole series, the log likelihood per block, and the summed transition weights.

    Scaled weights serve as long as they stay in range; blocks where they don't are done again in logarithms.
    """
    inside = np.arange(density.shape[1]) < n[:, None]
    counts = inside.astype(float)
    # Row 0 of the first block of a series has no row before it.
    counts[:, 0] = np.where(starts, 0.0, 1.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        alpha, log_like, b = _forward(density, n, _unit(heads), starts, a)
        beta = _backward(b, n, np.exp(tails - tails.max(-1, keepdims=True)), a)
        weak = _weak(alpha, inside) | _weak(beta, inside)
        gamma = alpha * beta
        gamma = np.where(inside[..., None], gamma / gamma.sum(-1, keepdims=True), 0.0)
    good = ~weak
    ahead = (b * beta)[good]
    left = np.concatenate([_unit(heads)[good][:, None], alpha[good][:, :-1]], axis=1)
    norm = np.einsum("rsi,ij,rsj->rs", left, a, ahead)
    weight = np.where(counts[good] > 0, 1.0 / np.where(norm > 0, norm, 1.0), 0.0)
    xi = np.einsum("rsi,rsj,rs->ij", left, ahead, weight) * a
    if weak.any():
        log_a, d = _logs(a), density[weak]
        la, lb, log_like[weak] = _in_logs(d, n[weak], heads[weak], starts[weak], tails[weak], log_a)
        gamma[weak] = np.where(inside[weak][..., None], _unit(la + lb), 0.0)
        before = np.concatenate([heads[weak][:, None], la[:, :-1]], axis=1)
        pairs = before[..., :, None] + log_a + (d + lb)[..., None, :]
        shares = np.exp(pairs - _lse(pairs.reshape(*pairs.shape[:2], -1), -1)[..., None, None])
        xi = xi + np.einsum("rsij,rs->ij", np.where(counts[weak][..., None, None] > 0, shares, 0.0), counts[weak])
    return gamma, log_like, xi


# ---- stitching long series --------------------------------------------------------------------


def _multiply(m: np.ndarray, step: np.ndarray, best: bool) -> np.ndarray:
    """Row-by-matrix products of log weights, in sums or in maxima, kept in range."""
    terms = m[..., :, :, None] + step[..., None, :, :]
    out = terms.max(-2) if best else _lse(terms, -2)
    top = out.max(axis=(-2, -1), keepdims=True)
    return out - np.where(np.isfinite(top), top, 0.0)


def _matrices(x: np.ndarray, n: np.ndarray, starts: np.ndarray, model: HmmModel, best: bool) -> np.ndarray:
    """What each block does to the log weights that enter it."""
    k, a = model.n_regimes, _logs(model.transitions)
    b = _log_density(x, model)
    b -= b.max(-1, keepdims=True)
    unit = np.full((k, k), -np.inf)
    np.fill_diagonal(unit, 0.0)
    m = np.where(starts[:, None, None], unit + b[:, 0, None, :], a + b[:, 0, None, :])
    for s in range(1, x.shape[1]):
        m = np.where((s < n)[:, None, None], _multiply(m, a + b[:, s, None, :], best), m)
    return m


def _block_matrices(model: HmmModel, best: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, x, n in _batches(frames, len(model.columns)):
            m = _matrices(x, n, (frame["block"] == 0).to_numpy(), model, best)
            out = frame.drop(columns=["xs"])
            out["m"] = list(m.reshape(len(n), -1))
            yield out

    return run


def _along(matrices: list[np.ndarray], head: np.ndarray, tail, best: bool):
    """Log weights at the heads and tails of consecutive pieces, given what enters the first and leaves the last."""
    heads = [head]
    for m in matrices:
        terms = heads[-1][:, None] + m
        out = terms.max(0) if best else _lse(terms, 0)
        heads.append(out - out.max())
    tails = [tail]
    if best and tail is None:
        tails = [np.array([float(np.argmax(heads[-1]))])]
    for j in range(len(matrices) - 1, 0, -1):
        if best:
            tails.append(np.array([float(np.argmax(heads[j] + matrices[j][:, int(tails[-1][0])]))]))
        else:
            out = _lse(matrices[j] + tails[-1], 1)
            tails.append(out - out.max())
    return heads[:-1], tails[::-1]


def _boundaries(matrices: DataFrame, keys: Sequence[str], model: HmmModel, longest: int, best: bool) -> DataFrame:
    """Rows ``(keys, block, head, tail)``. Series of more than ``FAN`` pieces are combined level by level,
    so no task sees more than ``FAN`` matrices of a series at a time."""
    k = model.n_regimes
    first = _logs(model.start)
    key_fields = [matrices.schema[c] for c in keys]
    doubles = T.ArrayType(T.DoubleType())
    ends = T.StructType(
        [*key_fields, T.StructField("block", T.LongType()), T.StructField("head", doubles), T.StructField("tail", doubles)]
    )

    def square(rows: pd.DataFrame) -> list[np.ndarray]:
        return [np.asarray(m).reshape(k, k) for m in rows["m"]]

    def place(rows: pd.DataFrame, head, tail) -> pd.DataFrame:
        rows = rows.sort_values("block")
        heads, tails = _along(square(rows), head, tail, best)
        return rows[[*keys, "block"]].assign(head=heads, tail=tails)

    if longest <= FAN:
        whole_tail = None if best else np.zeros(k)
        return matrices.groupBy(*keys).applyInPandas(lambda rows: place(rows, first, whole_tail), ends)

    grouped = matrices.withColumn("__group", F.floor(F.col("block") / FAN))

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        total, *rest = square(rows)
        for m in rest:
            total = _multiply(total, m, best)
        return rows[[*keys]].head(1).assign(block=int(rows["__group"].iloc[0]), m=[total.reshape(-1)])

    upper = T.StructType([*key_fields, T.StructField("block", T.LongType()), T.StructField("m", doubles)])
    outer = _boundaries(
        grouped.groupBy(*keys, "__group").applyInPandas(combine, upper), keys, model, -(-longest // FAN), best
    ).withColumnRenamed("block", "__group")

    def within(rows: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        return place(rows, np.asarray(edge["head"].iloc[0]), np.asarray(edge["tail"].iloc[0]))

    return (
        grouped.groupBy(*keys, "__group").cogroup(outer.groupBy(*keys, "__group")).applyInPandas(within, ends)
    )


def _with_boundaries(blocks: Blocks, model: HmmModel, best: bool) -> DataFrame:
    """Blocks with ``head`` and ``tail`` where their series spans several blocks."""
    needed = blocks.df.select(*blocks.keys, "block", "n_blocks", "xs")
    if blocks.longest <= 1:
        return needed.drop("n_blocks")
    schema = T.StructType(
        [*[blocks.df.schema[c] for c in blocks.keys], T.StructField("block", T.LongType()), T.StructField("m", T.ArrayType(T.DoubleType()))]
    )
    long_ones = needed.where(F.col("n_blocks") > 1).drop("n_blocks")
    matrices = long_ones.mapInPandas(_block_matrices(model, best), schema)
    edges = _boundaries(matrices, blocks.keys, model, blocks.longest, best)
    if blocks.stitched <= BROADCAST_BLOCKS:  # counted when packing; a few dozen bytes each
        edges = F.broadcast(edges)
    return join_keys(needed.drop("n_blocks"), edges, [*blocks.keys, "block"], "left")


# ---- fit --------------------------------------------------------------------------------------


def _statistics(model: HmmModel, frame: pd.DataFrame, x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log likelihood, first-row weights, transition, weight, first and second sums of a batch."""
    k = model.n_regimes
    heads, starts = _heads(frame, _logs(model.start))
    gamma, log_like, xi = _smooth(_log_density(x, model), n, heads, starts, _tails(frame, k), model.transitions)
    first = gamma[starts, 0].sum(0)
    moved = np.stack([np.einsum("rs,rsd->d", gamma[..., i], x - model.means[i]) for i in range(k)])
    spread = np.stack([np.einsum("rs,rsd->d", gamma[..., i], (x - model.means[i]) ** 2) for i in range(k)])
    return np.concatenate([[log_like.sum()], first, xi.ravel(), gamma.sum((0, 1)), moved.ravel(), spread.ravel()])


def _sufficient_statistics(model: HmmModel):
    """The statistics of all blocks of a task, summed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [_statistics(model, frame, x, n) for frame, x, n in _batches(frames, len(model.columns))]
        if found:
            yield pd.DataFrame({"stats": [np.sum(found, axis=0)]})

    return run


@contextmanager
def _small_batches(blocks: Blocks) -> Iterator[None]:
    """Passes over packed blocks read, and hand to Python, about ``BATCH_VALUES`` feature values at a time.

    Spark counts rows, and a row is a whole block here: at its own numbers a task would hold thousands of blocks at a time.
    """
    conf, most = blocks.df.sparkSession.conf, max(1, BATCH_VALUES * max(blocks.count, 1) // max(blocks.values, 1))
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: int(conf.get(name)) for name in names}
    try:
        for name, rows in before.items():
            conf.set(name, str(min(rows, most) if rows > 0 else most))
        yield
    finally:
        for name, rows in before.items():
            conf.set(name, str(rows))


def _expectation(blocks: Blocks, model: HmmModel) -> np.ndarray:
    with _small_batches(blocks):
        stats = _with_boundaries(blocks, model, best=False).mapInPandas(_sufficient_statistics(model), "stats array<double>")
        return np.sum([r["stats"] for r in stats.collect()], axis=0)


def _maximize(model: HmmModel, stats: np.ndarray) -> HmmModel:
    k, d = model.means.shape
    cuts = np.cumsum([1, k, k * k, k, k * d])
    _, first, xi, weight, moved, spread = np.split(stats, cuts)
    xi, moved, spread = xi.reshape(k, k), moved.reshape(k, d), spread.reshape(k, d)
    share = np.maximum(weight, 1e-300)[:, None]
    shift = moved / share
    variances = (VARIANCE_PRIOR + np.maximum(spread - share * shift**2, 0.0)) / share
    rows = xi.sum(1, keepdims=True)
    return HmmModel(
        model.columns,
        first / first.sum(),
        np.where(rows > 0, xi / np.where(rows > 0, rows, 1.0), model.transitions),
        np.where(weight[:, None] > 0, model.means + shift, model.means),
        np.where(weight[:, None] > 0, variances, model.variances),
    )


def _features(blocks: Blocks) -> DataFrame:
    """The packed feature rows, unpacked."""
    d = len(blocks.columns)
    starts = F.sequence(F.lit(0), (F.size("xs") / d).cast("int") - 1)
    rows = blocks.df.select(F.explode(F.transform(starts, lambda i: F.slice("xs", i * d + 1, d))).alias("x"))
    return rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(blocks.columns)])


def initial_model(blocks: Blocks, n_regimes: int = REGIMES, seed: int = SEED) -> HmmModel:
    """Even start and transition weights, k-means centres, the overall variance for every regime."""
    rows, columns = _features(blocks), list(blocks.columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(rows).select("features")
    with _small_batches(blocks):
        # k-means keeps rows that are not kept yet as objects in the executors' heaps.
        vectors.persist(StorageLevel.DISK_ONLY)
        try:
            centres = KMeans(k=n_regimes, seed=seed, featuresCol="features").fit(vectors).clusterCenters()
        finally:
            vectors.unpersist()
        spread = rows.agg(*[F.var_samp(c).alias(c) for c in columns]).collect()[0]
    # k-means may find fewer centres than asked for; a copy keeps the shape.
    means = np.array([centres[i % len(centres)] for i in range(n_regimes)], dtype=float)
    variances = np.tile([float(spread[c] or 0.0) + VARIANCE_FLOOR for c in columns], (n_regimes, 1))
    even = np.full(n_regimes, 1.0 / n_regimes)
    return HmmModel(blocks.columns, even, np.tile(even, (n_regimes, 1)), means, variances)


class _Held:
    """The blocks that one task of a barrier stage keeps, in order of their series."""

    def __init__(self, frame: pd.DataFrame, keys: Sequence[str], width: int):
        batches = _batches(iter([frame.assign(lane=np.arange(len(frame)))] if len(frame) else []), width)
        self.batches = [(part.drop(columns="xs"), x, n) for part, x, n in batches]  # features once, as arrays
        names = [json.dumps([str(v) for v in row]) for row in frame[list(keys)].itertuples(index=False)] if keys else ["[]"] * len(frame)
        self.series = np.array(names, dtype=object)
        self.block, self.blocks = frame["block"].to_numpy(), frame["n_blocks"].to_numpy()
        long_ones = np.flatnonzero(self.blocks > 1)
        cuts = np.flatnonzero(np.append(True, self.series[long_ones[1:]] != self.series[long_ones[:-1]])[: len(long_ones)])
        self.pieces = [list(p) for p in np.split(long_ones, cuts[1:])] if len(long_ones) else []

    def products(self, model: HmmModel) -> dict[int, np.ndarray]:
        """Matrices of the blocks of series that span several."""
        out = {}
        for frame, x, n in self.batches:
            at = np.flatnonzero((frame["n_blocks"] > 1).to_numpy())
            if len(at):
                steps = int(n[at].max())
                m = _matrices(x[at, :steps], n[at], (frame["block"].iloc[at] == 0).to_numpy(), model, False)
                out |= dict(zip(frame["lane"].iloc[at].tolist(), m))
        return out

    def open_pieces(self, matrices: dict[int, np.ndarray]) -> list[tuple[str, np.ndarray]]:
        """Of the (at most two) series that go on in other tasks: the product of the blocks that are here."""
        out = []
        for piece in self.pieces:
            if self.block[piece[0]] > 0 or self.block[piece[-1]] + 1 < self.blocks[piece[-1]]:
                total = matrices[piece[0]]
                for lane in piece[1:]:
                    total = _multiply(total, matrices[lane], False)
                out.append((self.series[piece[0]], total))
        return out

    def stitch(self, model: HmmModel, matrices: dict[int, np.ndarray], others: list[list[tuple[str, np.ndarray]]], own: int) -> None:
        """Give each block of a long series what enters it from both sides; ``others`` are the open pieces of all tasks."""
        ends: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for piece in self.pieces:
            head, tail = _logs(model.start), np.zeros(model.n_regimes)
            around = [(task, m) for task, found in enumerate(others) for name, m in found if name == self.series[piece[0]]]
            place = [task for task, _ in around]
            if own in place:
                heads, tails = _along([m for _, m in around], head, tail, False)
                head, tail = heads[place.index(own)], tails[place.index(own)]
            heads, tails = _along([matrices[lane] for lane in piece], head, tail, False)
            ends |= {lane: pair for lane, *pair in zip(piece, heads, tails)}
        for frame, _, _ in self.batches:
            frame["head"] = [ends[lane][0] if lane in ends else None for lane in frame["lane"]]
            frame["tail"] = [ends[lane][1] if lane in ends else None for lane in frame["lane"]]


def _text(values: np.ndarray) -> str:
    return base64.b64encode(np.ascontiguousarray(values, dtype=float).tobytes()).decode()


def _values(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), float)


def _rounds_in_stage(
    blocks: Blocks, model: HmmModel, n_iter: int, tol: float, before: float | None, tasks: int, probe: Callable[[int], None] | None = None
) -> tuple[HmmModel, list[float], bool, float]:
    """Up to ``n_iter`` rounds in one barrier stage: the model, the log likelihoods, whether the gain fell below ``tol``, and
    the log likelihood of the result. ``before`` is the log likelihood of an earlier stage's last round."""
    keys, k, stitched = blocks.keys, model.n_regimes, blocks.stitched > 0
    # Series that fit into a task stay whole, which saves one of the two exchanges of a round.
    longest_values = blocks.longest * (blocks.values // max(blocks.count, 1) + 1)
    whole = bool(keys) and longest_values * tasks <= max(blocks.values, TASK_VALUES // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        frames = [b.to_pandas() for b in batches]
        columns = [*keys, "block", "n_blocks", "xs"]
        held = _Held(pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=columns), keys, len(model.columns))
        frames.clear()
        own, now, trace, done = context.partitionId(), model, [] if before is None else [before], False

        def expectation() -> np.ndarray:
            if stitched:
                matrices = held.products(now)
                mine = [(name, _text(m.ravel())) for name, m in held.open_pieces(matrices)]
                said = [] if whole else context.allGather(json.dumps(mine))
                told = [[(name, _values(t).reshape(k, k)) for name, t in json.loads(x)] for x in said]
                held.stitch(now, matrices, told, own)
            size = 1 + k + k * k + k + 2 * k * len(now.columns)
            sums = sum((_statistics(now, *b) for b in held.batches), np.zeros(size))
            # Every task adds the same numbers in the same order, so all go on with the same model.
            return np.sum([_values(x) for x in context.allGather(_text(sums))], axis=0)

        for turn in range(n_iter):
            if probe is not None:
                probe(turn)
            stats = expectation()
            if not np.isfinite(stats).all():
                raise FloatingPointError("the fit left the number range; are all features finite?")
            trace.append(float(stats[0]))
            now = _maximize(now, stats)
            if len(trace) > 1 and trace[-1] - trace[-2] < tol:
                done = True
                break
        final = float(expectation()[0])
        if own == 0:
            flat = np.concatenate([now.start, now.transitions.ravel(), now.means.ravel(), now.variances.ravel()])
            yield pa.RecordBatch.from_pydict(
                {"model": [flat.tolist()], "trace": [trace if before is None else trace[1:]], "done": [done], "final": [final]}
            )

    rows = blocks.df.select(*keys, "block", "n_blocks", "xs")
    dealt = rows.repartition(tasks, *keys) if whole else rows.repartitionByRange(tasks, *keys, "block")
    dealt = dealt.sortWithinPartitions(*keys, "block")
    made = dealt.mapInArrow(run, "model array<double>, trace array<double>, done boolean, final double", barrier=True)
    # Behind an exchange: Spark runs a failed barrier stage again only if it is not the last one of its job.
    with _small_batches(blocks):
        made = made.repartition(1).collect()[0]
    d = len(model.columns)
    start, transitions, means, variances = np.split(np.array(made["model"]), np.cumsum([k, k * k, k * d]))
    found = HmmModel(model.columns, start, transitions.reshape(k, k), means.reshape(k, d), variances.reshape(k, d))
    return found, list(made["trace"]), made["done"], made["final"]


def stage_tasks(blocks: Blocks) -> int:
    """How many tasks of one barrier stage keep all blocks; 0 if they can't, or if executors come and go."""
    spark = blocks.df.sparkSession
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    slots = spark.sparkContext.defaultParallelism
    return max(1, min(slots, blocks.count)) if blocks.values <= slots * TASK_VALUES else 0


def fit(
    df: DataFrame,
    columns: Sequence[str],
    n_regimes: int = REGIMES,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    n_iter: int = ITERATIONS,
    tol: float = TOLERANCE,
    seed: int = SEED,
    start_from: HmmModel | None = None,
    block_rows: int | None = None,
    max_rows: int | None = MAX_ROWS,
    blocks: Blocks | None = None,
    one_stage: bool | None = None,
) -> HmmModel:
    """Expectation maximisation until the log likelihood gains less than ``tol``.

    With ``one_stage`` the rounds run inside barrier stages of ``STAGE_ROUNDS`` rounds, else each is one pass over the stored
    blocks; the driver only sees an array of sums for each task. Left open, the size of the blocks decides; both ways give the same model.
    """
    packed = blocks or pack(df, columns, keys, ts, tie, block_rows or BLOCK_ROWS, max_rows)
    tasks = stage_tasks(packed) if one_stage is not False else 0
    if one_stage and not tasks:
        raise ValueError("the blocks do not fit into one barrier stage")
    few = packed.count < STAGE_LANES * packed.df.sparkSession.sparkContext.defaultParallelism
    if tasks and few and blocks is None and block_rows is None:
        packed = pack(df, columns, keys, ts, tie, STAGE_BLOCK_ROWS, max_rows)
        tasks = stage_tasks(packed)
    model = start_from or initial_model(packed, n_regimes, seed)
    trace: list[float] = []
    final = None
    while tasks and len(trace) < n_iter:
        rounds = min(STAGE_ROUNDS, n_iter - len(trace))
        model, gained, done, final = _rounds_in_stage(packed, model, rounds, tol, trace[-1] if trace else None, tasks)
        trace += gained
        if done:
            break
    for _ in range(0 if tasks else n_iter):
        stats = _expectation(packed, model)
        if not np.isfinite(stats).all():
            raise FloatingPointError("the fit left the number range; are all features finite?")
        trace.append(float(stats[0]))
        model = _maximize(model, stats)
        if len(trace) > 1 and trace[-1] - trace[-2] < tol:
            break
    final = float(_expectation(packed, model)[0]) if final is None else final
    return HmmModel(model.columns, model.start, model.transitions, model.means, model.variances, final, tuple(trace))


# ---- use --------------------------------------------------------------------------------------


def log_likelihood(blocks: Blocks, model: HmmModel) -> DataFrame:
    """Log likelihood of each series."""
    keys = list(blocks.keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, x, n in _batches(frames, len(model.columns)):
            heads, starts = _heads(frame, _logs(model.start))
            log_like = _log_likelihoods(_log_density(x, model), n, heads, starts, model.transitions)
            yield frame[keys].assign(log_likelihood=log_like)

    schema = T.StructType([*[blocks.df.schema[c] for c in keys], T.StructField("log_likelihood", T.DoubleType())])
    parts = _with_boundaries(blocks, model, best=False).mapInPandas(run, schema)
    return parts.groupBy(*keys).agg(F.sum("log_likelihood").alias("log_likelihood"))


def _unpack(blocks: Blocks, arrays: DataFrame, columns: list[str]) -> DataFrame:
    """One row per packed row again: keys, place and the given arrays' values."""
    joined = join_keys(blocks.df.select(*blocks.keys, "block", "places"), arrays, [*blocks.keys, "block"], "inner")
    rows = joined.select(*blocks.keys, F.explode(F.arrays_zip("places", *columns)).alias("__r"))
    return rows.select(
        *blocks.keys, *[F.col(f"__r.places.{p}").alias(p) for p in blocks.place], *[F.col(f"__r.{c}").alias(c) for c in columns]
    )


def posterior(blocks: Blocks, model: HmmModel) -> DataFrame:
    """Probability of each regime per row, given its whole series."""
    keys, k = list(blocks.keys), model.n_regimes
    names = [f"regime_proba_{i}" for i in range(k)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, x, n in _batches(frames, len(model.columns)):
            heads, starts = _heads(frame, _logs(model.start))
            gamma, _, _ = _smooth(_log_density(x, model), n, heads, starts, _tails(frame, k), model.transitions)
            out = frame[[*keys, "block"]].copy()
            for i, name in enumerate(names):
                out[name] = [gamma[lane, :length, i] for lane, length in enumerate(n)]
            yield out

    arrays = _with_boundaries(blocks, model, best=False).mapInPandas(run, _array_schema(blocks, names, T.DoubleType()))
    return _unpack(blocks, arrays, names)


def decode(blocks: Blocks, model: HmmModel) -> DataFrame:
    """The most likely sequence of regimes of each series."""
    keys, k = list(blocks.keys), model.n_regimes
    with np.errstate(divide="ignore"):
        log_a, log_start = np.log(model.transitions), np.log(model.start)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, x, n in _batches(frames, len(model.columns)):
            b = _log_density(x, model)
            heads, starts = _heads(frame, log_start)
            lanes, steps = b.shape[:2]
            came_from = np.zeros((lanes, steps, k), dtype=np.int8)
            entering = heads[:, :, None] + log_a
            now = np.where(starts[:, None], heads, entering.max(1)) + b[:, 0]
            for s in range(1, steps):
                options = now[:, :, None] + log_a
                came_from[:, s] = options.argmax(1)
                now = np.where((s < n)[:, None], options.max(1) + b[:, s], now)
            state = now.argmax(1)
            if "tail" in frame:
                for i, t in enumerate(frame["tail"]):
                    if t is not None:
                        state[i] = int(t[0])
            path = np.zeros((lanes, steps), dtype=np.int32)
            for s in range(steps - 1, -1, -1):
                path[:, s] = state
                state = np.where(s < n, came_from[np.arange(lanes), s, state], state) if s else state
            out = frame[[*keys, "block"]].copy()
            out["regime_id"] = [path[lane, :length] for lane, length in enumerate(n)]
            yield out

    arrays = _with_boundaries(blocks, model, best=True).mapInPandas(
        run, _array_schema(blocks, ["regime_id"], T.IntegerType())
    )
    return _unpack(blocks, arrays, ["regime_id"])


def label_counts(labelled: DataFrame, regime: str = "regime_id") -> DataFrame:
    """How many rows each regime has; rows without a regime are counted too."""
    return labelled.groupBy(regime).agg(F.count(F.lit(1)).alias("n_rows"))


def _array_schema(blocks: Blocks, names: Sequence[str], kind: T.DataType) -> T.StructType:
    return T.StructType(
        [
            *[blocks.df.schema[c] for c in blocks.keys],
            T.StructField("block", T.LongType()),
            *[T.StructField(n, T.ArrayType(kind)) for n in names],
        ]
    )


def attach_regimes(
    df: DataFrame,
    model: HmmModel,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    max_rows: int | None = MAX_ROWS,
    blocks: Blocks | None = None,
) -> DataFrame:
    """Rows plus regime, its probabilities and its name. Rows are matched by keys, timestamp and tie."""
    packed = blocks or pack(df, model.columns, keys, ts, tie, block_rows, max_rows)
    on = [*keys, ts, *tie]
    found = join_keys(decode(packed, model), posterior(packed, model), on, "inner")
    return join_keys(df, found, on, "left").withColumn("regime_name", regime_name(F.col("regime_id")))


# ---- storage ----------------------------------------------------------------------------------


def model_table(spark: SparkSession, model: HmmModel) -> DataFrame:
    """Parameters as rows: kind, regime, target regime or column, value."""
    k = range(model.n_regimes)
    rows = [("start", i, None, None, float(model.start[i])) for i in k]
    rows += [("transition", i, j, None, float(model.transitions[i, j])) for i in k for j in k]
    for kind, values in (("mean", model.means), ("variance", model.variances)):
        rows += [(kind, i, d, c, float(values[i, d])) for i in k for d, c in enumerate(model.columns)]
    rows.append(("log_likelihood", None, None, None, model.log_likelihood))
    return spark.createDataFrame(rows, "kind string, regime_id int, index int, column_name string, value double")


def save_model(spark: SparkSession, model: HmmModel, path: str) -> None:
    model_table(spark, model).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> HmmModel:
    rows = spark.read.parquet(path).collect()  # a few values per regime and column
    names = {r["index"]: r["column_name"] for r in rows if r["kind"] == "mean"}
    columns = tuple(names[i] for i in range(len(names)))
    k = sum(r["kind"] == "start" for r in rows)
    start, transitions = np.zeros(k), np.zeros((k, k))
    tables = {"mean": np.zeros((k, len(columns))), "variance": np.zeros((k, len(columns)))}
    likelihood = float("nan")
    for r in rows:
        if r["kind"] == "start":
            start[r["regime_id"]] = r["value"]
        elif r["kind"] == "transition":
            transitions[r["regime_id"], r["index"]] = r["value"]
        elif r["kind"] == "log_likelihood":
            likelihood = r["value"]
        else:
            tables[r["kind"]][r["regime_id"], r["index"]] = r["value"]
    return HmmModel(columns, start, transitions, tables["mean"], tables["variance"], likelihood)
