"""Alignment of two tokenizers over the same bytes, by merge path.

Both tokenizers cut the same bytes (a space and the text) into tokens, so the ends of their tokens are two
ascending lists over one byte axis. Merging the lists walks a path through their grid; a binary search along
evenly spaced diagonals finds where the path crosses each of them, which cuts the merge into independent pieces of
equal work, whatever the lengths of the texts. Each piece walks its part and gives the overlaps it passes and the
ends that both lists share; the numbers of shared ends, summed over the pieces, stitch what crosses a border
between two pieces into groups.

``align`` is one narrow pass; the pairs of ids that overlap in a document stay with it, packed. ``link_counts`` adds
them up over all documents (within each task first), and ``score`` looks the sums up again: up to ``max_pairs``
frequent pairs in sorted arrays sent to the tasks, the rest by a join.

Texts that are missing or empty, or that a tokenizer does not give back byte by byte, have no tokens: all counts
are 0 and ``groups`` is the empty string. Special tokens that stand in a text are plain text. Every row is counted,
repeated ones too; ids may be missing. A kept column gives way to a made one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm import bpe
from tideshift.llm.common import map_texts, with_fields
from tideshift.session import scratch_path, settle

PIECE_STEPS = 128  # steps of the path that one piece walks
MAX_PAIRS = 8_000_000  # id pairs that are looked up in arrays of 16 bytes a pair
PAIRS_AT_ONCE = 1_000_000
WORD_GAP = "▁"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass(frozen=True)
class Tokenizers:
    """The files of a byte-level tokenizer (A) and of a piece tokenizer with byte fallback (B)."""

    a_file: bytes
    a: bpe.Vocabulary
    b_file: bytes

    @property
    def a_size(self) -> int:
        return len(self.a.tokens)


def load_tokenizers(a_path: str, b_path: str) -> Tokenizers:
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return Tokenizers(a.read(), bpe.load_vocabulary(a_path), b.read())


class ByteTokens:
    """Ids and token bytes of a byte-level vocabulary."""

    def __init__(self, made: Tokenizers):
        self.plain = tokenizers.Tokenizer.from_buffer(made.a_file)
        self.plain.encode_special_tokens = True
        self.plain.no_truncation()
        self.plain.no_padding()
        self.decoder = bpe.Decoder(made.a)
        special = set(made.a.special.values())
        ranks = {t: i for i, t in enumerate(made.a.tokens) if t and i not in special}
        merged = sorted((r, i) for i, r in enumerate(made.a.ranks) if r >= 0)
        # Where ids rise with the ranks of the merges, the same merges can be done by id, which is faster.
        rising = all(x[1] < y[1] for x, y in zip(merged, merged[1:])) and (not merged or merged[0][1] >= 256)
        self.fast = tiktoken.Encoding("a", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={}) if rising else None

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as e:  # the pattern engine gives up on some very long runs of white space
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


class PieceTokens:
    """Ids and token bytes of a piece vocabulary, which puts a space in front of the text by itself."""

    def __init__(self, made: Tokenizers):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=made.b_file)
        tokens = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            tokens.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(WORD_GAP, " ").encode())
        self.decoder = bpe.Decoder(bpe.Vocabulary(tokens, [], [], {}))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Path:
    """Steps of a merge, in order: the token of A and of B at each, which list moves on, and the shared ends."""

    i: np.ndarray
    j: np.ndarray
    from_a: np.ndarray
    shared: np.ndarray
    group: np.ndarray

    @property
    def links(self) -> np.ndarray:
        """Every step but the second half of a shared end passes one overlap."""
        return ~self.shared


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of A lie among the first ends of the merge, for each of the given numbers; A goes first in ties."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        at = np.flatnonzero(open_)
        first = a[mid[at]] <= b[diagonals[at] - 1 - mid[at]]
        low[at[first]] = mid[at[first]] + 1
        high[at[~first]] = mid[at[~first]]
    return low


def merge_path(a: np.ndarray, b: np.ndarray, steps: int = PIECE_STEPS) -> Path:
    """Merge two ascending lists of ends whose last ends are equal."""
    total = len(a) + len(b)
    starts = np.arange(0, total, steps)
    i = crossings(a, b, starts)
    j = starts - i
    beyond = np.int64(np.iinfo(np.int64).max)
    ends_a, ends_b = np.append(a, beyond), np.append(b, beyond)
    shape = (steps, len(starts))
    at_a, at_b = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    from_a, shared = np.zeros(shape, bool), np.zeros(shape, bool)
    for step in range(steps):  # all pieces walk at once; only the last one may run out
        take = ends_a[i] <= ends_b[j]
        at_a[step], at_b[step], from_a[step] = i, j, take
        shared[step] = ~take & (i > 0) & (ends_a[i - 1] == ends_b[j])
        i = np.minimum(i + take, len(a))
        j = np.minimum(j + ~take, len(b))
    flat = [x.T.reshape(-1)[:total] for x in (at_a, at_b, from_a, shared)]
    # Stitch: groups closed in the pieces before, and before each step within its piece.
    shared[:, -1] &= np.arange(steps) < total - starts[-1] if len(starts) else True
    closed = shared.sum(axis=0)
    before = np.cumsum(closed) - closed
    group = (np.cumsum(shared, axis=0) - shared + before).T.reshape(-1)[:total]
    return Path(*flat, group)


class GroupTexts:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``: decimal ids in order, A's before B's."""

    def __init__(self, ids: int):
        self.names = pa.array([f"{i}{mark}" for i in range(ids) for mark in ",|;"], pa.large_string())

    def write(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All tokens' texts after one another, and where the text of each starts."""
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        ends_a = np.cumsum(np.bincount(group_a, minlength=groups))
        sizes_b = np.bincount(group_b, minlength=groups)
        place_a = np.arange(len(a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]
        place_b = np.arange(len(b)) + ends_a[group_b]
        last_a, last_b = np.append(np.diff(group_a) > 0, True)[: len(a)], np.append(np.diff(group_b) > 0, True)[: len(b)]
        names = np.empty(len(a) + len(b), np.int64)
        names[place_a] = a.astype(np.int64) * 3 + last_a
        names[place_b] = b.astype(np.int64) * 3 + 2 * last_b
        written = self.names.take(pa.array(names))
        _, offsets, data = written.buffers()
        starts = np.frombuffer(offsets, np.int64)[written.offset : written.offset + len(names) + 1]
        return (data.to_pybytes() if data is not None else b""), starts


def planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane: small ones leave runs of zeros, which every codec shrinks to nothing."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).reshape(8, -1).T.copy().view("<u8").reshape(-1).astype(np.int64)


def _column(values: list | np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)


def align(df: DataFrame, made: Tokenizers, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (text), and the document's distinct
    pairs of overlapping ids with how often each occurs (``pairs`` and ``times``, packed)."""
    fields = [(n, T.LongType()) for n in COUNTS] + [("groups", T.StringType()), ("pairs", T.BinaryType()), ("times", T.BinaryType())]
    schema = with_fields(df, keep, fields)
    kept = [f.name for f in schema.fields if f.name not in dict(fields)]
    # Plain values, bounded by the tokenizers' size.
    shared = df.sparkSession.sparkContext.broadcast((made.a_file, (made.a.tokens, made.a.parts, made.a.ranks, made.a.special), made.b_file))

    def work():
        a_file, a, b_file = shared.value
        made = Tokenizers(a_file, bpe.Vocabulary(*a), b_file)
        one, two = ByteTokens(made), PieceTokens(made)
        size_b = len(two.decoder.offsets) - 1
        texts = GroupTexts(max(len(one.decoder.offsets) - 1, size_b))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = aligned(batch.column(text).fill_null("").to_pylist(), one, two, size_b, texts)
            columns = {
                **{n: _column(values[n], pa.int64()) for n in COUNTS},
                "groups": _column(values["groups"], pa.string()),
                "pairs": _column(values["pairs"], pa.binary()),
                "times": _column(values["times"], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else batch.column(f.name) for f in schema.fields], names=schema.names
            )

        return step

    return map_texts(df.select(*dict.fromkeys([*kept, text])), work, schema, text)


def aligned(texts: list[str], one: ByteTokens, two: PieceTokens, size_b: int, names: GroupTexts) -> dict[str, list]:
    """What ``align`` adds to each of the texts."""
    rows = len(texts)
    ids_a = [one.encode(" " + t) if t else np.zeros(0, np.uint32) for t in texts]
    ids_b = [np.array(x, np.int64) for x in two.encode(texts)]
    for d, text in enumerate(texts):
        wanted = b" " + text.encode()
        if not text or not (_joined(one, ids_a[d]) == wanted == _joined(two, ids_b[d])):
            ids_a[d], ids_b[d] = ids_a[d][:0], ids_b[d][:0]
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a = np.concatenate([*ids_a, np.zeros(0, np.uint32)]).astype(np.int64)
    b = np.concatenate([*ids_b, np.zeros(0, np.int64)])
    path = merge_path(_ends(one, a), _ends(two, b))
    row_a, row_b = np.repeat(np.arange(rows), n_a), np.repeat(np.arange(rows), n_b)
    n_groups = np.bincount(row_b[path.j[path.shared]], minlength=rows)
    link_a, link_b = path.i[path.links], path.j[path.links]
    link_row = row_a[link_a]
    n_links = np.bincount(link_row, minlength=rows)

    written, starts = names.write(a, b, path.group[path.from_a], path.group[~path.from_a])
    bounds = starts[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    groups = [written[x : y - 1].decode() if y > x else "" for x, y in zip(bounds, bounds[1:])]

    pair = a[link_a] * size_b + b[link_b]
    order = np.lexsort((pair, link_row))
    pair, link_row = pair[order], link_row[order]
    fresh = np.append(True, (np.diff(pair) != 0) | (np.diff(link_row) != 0)) if len(pair) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(pair)))
    pair, cut = pair[first], np.searchsorted(link_row[first], np.arange(rows + 1))
    packed = [planes(np.diff(pair[x:y], prepend=0)) for x, y in zip(cut, cut[1:])]
    often = [planes(times[x:y]) for x, y in zip(cut, cut[1:])]
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": groups, "pairs": packed, "times": often}


def _joined(tokens: ByteTokens | PieceTokens, ids: np.ndarray) -> bytes:
    return tokens.decoder.decode(ids.astype(np.int64), np.zeros(1, np.int64))[0].tobytes()


def _ends(tokens: ByteTokens | PieceTokens, ids: np.ndarray) -> np.ndarray:
    return np.cumsum(tokens.decoder.offsets[ids + 1] - tokens.decoder.offsets[ids])


def _pairs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, how often each occurs, and how many each row has."""
    pairs = [np.cumsum(from_planes(p)) for p in batch.column("pairs").to_pylist()]
    times = [from_planes(t) for t in batch.column("times").to_pylist()]
    none = np.zeros(0, np.int64)
    return np.concatenate([*pairs, none]), np.concatenate([*times, none]), np.array([len(p) for p in pairs], np.int64)


def _sums(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pair, kind="stable")
    pair, n = pair[order], n[order]
    first = np.flatnonzero(np.append(True, np.diff(pair) != 0)) if len(pair) else np.zeros(0, np.int64)
    return pair[first], np.add.reduceat(n, first) if len(first) else n[:0]


def link_counts(stored: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` (how many links of all documents hold it) and ``best`` (whether no pair of its B id has more)."""
    schema = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting, last = 0, 0
        for batch in batches:
            pair, times, _ = _pairs_of(batch)
            held.append(_sums(pair, times))
            waiting += len(held[-1][0])
            if waiting > last + PAIRS_AT_ONCE:
                held = [_sums(*(np.concatenate(x) for x in zip(*held)))]
                waiting = last = len(held[0][0])
                if waiting > PAIRS_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["pair", "n"])
                    held, waiting, last = [], 0, 0
        if held:
            made = _sums(*(np.concatenate(x) for x in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["pair", "n"])

    counts = settle(stored.select("pairs", "times").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n")))
    of_b = F.col("pair") % size_b
    most = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))  # at most one row for each id of B
    return settle(counts.join(F.broadcast(most), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def score(stored: DataFrame, counts: DataFrame, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``stored`` (aligned rows with a number in ``row``) with ``n_best`` and ``count_sum`` in place of the packed pairs."""
    floor = _floor(counts, max_pairs)
    frequent = counts.where(F.col("n") >= floor).toArrow()
    pair = frequent.column("pair").to_numpy()
    order = np.argsort(pair)
    table = (pair[order], frequent.column("n").to_numpy()[order], frequent.column("best").to_numpy(zero_copy_only=False)[order])
    shared = stored.sparkSession.sparkContext.broadcast(table)  # at most max_pairs rows

    kept = [f for f in stored.schema.fields if f.name not in ("pairs", "times")]
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def looked_up(batch: pa.RecordBatch):
        keys, n, best = shared.value
        pair, times, sizes = _pairs_of(batch)
        row = np.repeat(np.arange(batch.num_rows), sizes)
        if not len(keys):
            return pair, times, row, np.zeros(len(pair), bool), times * 0, times * 0
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        there = keys[at] == pair
        return pair, times, row, there, np.where(there, times * n[at], 0), np.where(there & best[at], times, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, row, _, total, best = looked_up(batch)
            sums = []
            for part in (best, total):
                out = np.zeros(batch.num_rows, np.int64)
                np.add.at(out, row, part)
                sums.append(pa.array(out))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *sums], names=schema.names)

    done = stored.mapInArrow(run, schema)
    if floor <= 1:
        return done
    rest = T.StructType([T.StructField(n, T.LongType()) for n in ("row", "pair", "times")])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, times, row, there, _, _ = looked_up(batch)
            number = batch.column("row").to_numpy()[row[~there]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (number, pair[~there], times[~there])], names=rest.names)

    # A pair that was not sent has fewer than `floor` links, so no key of this join is hot.
    more = (
        stored.select("row", "pairs", "times").mapInArrow(others, rest).join(counts.where(F.col("n") < floor), "pair")
        .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    )
    return done.join(more, "row", "left").select(
        *[f.name for f in kept],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
    )


def _floor(counts: DataFrame, max_pairs: int) -> int:
    """Least count of the pairs that are sent: a power of two, so that at most ``max_pairs`` have it."""
    sizes = counts.groupBy(F.floor(F.log2("n") + 1e-9).alias("bits")).agg(F.count("*").alias("pairs")).collect()  # at most 63 rows
    held, floor = 0, 1 << 62
    for r in sorted(sizes, key=lambda r: -r["bits"]):
        held += r["pairs"]
        if held > max_pairs:
            return floor
        floor = 1 << int(r["bits"])
    return 1


def count_and_score(aligned_rows: DataFrame, made: Tokenizers, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Store aligned rows once, count their links over all of them, and give each row its ``n_best`` and ``count_sum``."""
    path = scratch_path(aligned_rows.sparkSession, "aligned")
    numbered = aligned_rows.withColumn("row", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(path)
    stored = aligned_rows.sparkSession.read.schema(numbered.schema).parquet(path)
    size_b = sentencepiece.SentencePieceProcessor(model_proto=made.b_file).vocab_size()
    return score(stored, link_counts(stored, size_b), max_pairs).drop("row")
