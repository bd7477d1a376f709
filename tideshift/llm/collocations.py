"""Phrase collocations, counted with weighted acyclic automata.

1. ``count_words`` counts the words of each language and gives every (language, word) its symbol, a 64-bit digest; should two words
   meet in one symbol, all symbols are made anew with the next seed. Only words that occur often enough go on: no frequent
   phrase holds another one. ``frequent_pairs`` does the same for pairs of neighbouring words, by digest: runs of words end where
   a pair is rare. Its table of bits has a bounded size; a full one lets more n-grams through and changes no result.
2. ``shards``: each task turns its texts into sorted n-grams of one to four words, slice by slice, and adds them up; what it holds is cut
   at fixed bounds into prefix ranges and sent as minimal automata. The bounds come from n-grams of a sample of documents; they
   only decide how evenly the work is spread. A bound is a whole n-gram, so even one pair of words that starts a third of all n-grams is divided.
3. ``frequent``: each prefix range adds its automata up and drops what stays below the threshold.
4. ``scored``: a range asks the ranges that hold them for the counts of the parts of its phrases, each part once; these compose the parts with
   their automata, and the answers come back. So a part of very many phrases costs one row for each range.
5. ``rank`` drops phrases inside longer ones and takes the best of each language.

Missing and empty texts hold no words; a missing language is ``und``, as is a language of that name. Repeated rows count each
time. Ties are ordered by count, then by phrase in byte order. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm import count_automata as ca
from tideshift.llm.common import bounded_batches, map_texts, mix64, slices, utf8
from tideshift.session import settle, shuffle_partitions

MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
INSIDE_SHARE = (100, 80)  # a phrase goes if 100 * f(longer) >= 80 * f(phrase)
UNDETERMINED = "und"
MAX_WORDS = 8_000_000  # frequent words that are sent to the tasks (8 bytes each); beyond it no word is left out early
PAIR_BITS = 30  # logarithm of the largest table of frequent pairs, in bits (128 MB)
BITS_PER_PAIR = 16
HELD_PAIRS = 1_000_000
HELD_NODES = 2_000_000  # n-grams that a task adds up before it sends them on
WORDS_PER_RANGE = 2_000_000
MAX_RANGES = 1_000_000
SAMPLE_WORDS = 1_000_000
KEYS_PER_RANGE = 64

# Kinds of bytes: parts of words, what stands between words, what stands between pieces.
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = 1
KINDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NAMES = [f"w{k}" for k in range(1, ca.LONGEST + 1)]


@dataclass(frozen=True)
class Words:
    """The words of several texts in order: distinct (language, word) pairs, which of them each word is, and its piece."""

    languages: list[str]
    language: np.ndarray  # of each distinct pair
    texts: list[str]  # of each distinct pair
    symbols: np.ndarray  # of each distinct pair
    word: np.ndarray
    piece: np.ndarray


def symbols_of(texts: list[str], language: np.ndarray, languages: list[str], seed: int) -> np.ndarray:
    """Digests of words with their languages; never 0."""
    own = np.fromiter((xxhash.xxh3_64_intdigest(t, seed) for t in texts), np.uint64, len(texts))
    of = np.fromiter((xxhash.xxh3_64_intdigest(t, seed + 1) for t in languages), np.uint64, len(languages))
    return np.maximum(mix64(own + mix64(of)[language]), np.uint64(1)) if len(texts) else own


def read_words(batch: pa.RecordBatch, seed: int) -> Words:
    """Split the texts of a batch (columns ``text`` and ``lang``) into pieces and words."""
    data, offsets = utf8(batch.column("text"))
    kinds = KINDS[data]
    opens = np.zeros(len(data), bool)
    opens[offsets[:-1][np.diff(offsets) > 0]] = True
    inside = kinds == 0
    starts = inside.copy()
    starts[1:] &= opens[1:] | ~inside[:-1]
    at = np.flatnonzero(starts)
    piece = np.cumsum((kinds == 2) | opens)[at]
    row = np.searchsorted(offsets, at, side="right") - 1
    letters = LOWER[data[inside]]
    bounds = np.append((np.cumsum(inside) - 1)[at], len(letters))
    kind = pa.string() if len(letters) < 1 << 31 else pa.large_string()
    width = np.int32 if kind == pa.string() else np.int64
    words = pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(bounds.astype(width).tobytes()), pa.py_buffer(letters.tobytes())])
    named = words.dictionary_encode()
    languages = batch.column("lang").fill_null(UNDETERMINED).dictionary_encode()
    size = max(len(named.dictionary), 1)
    keys = languages.indices.to_numpy()[row].astype(np.int64) * size + named.indices.to_numpy()
    distinct, word = np.unique(keys, return_inverse=True)
    texts = named.dictionary.take(pa.array(distinct % size)).to_pylist()
    names = languages.dictionary.to_pylist()
    language = distinct // size
    return Words(names, language, texts, symbols_of(texts, language, names, seed), word.reshape(-1), piece)


def prepared(df: DataFrame, text: str, lang: str) -> DataFrame:
    return df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))


def count_words(df: DataFrame) -> tuple[DataFrame, int]:
    """``lang``, ``word``, ``symbol`` and ``n`` of all words, and the seed of the symbols. ``df`` has ``text`` and ``lang``."""
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()),
        T.StructField("symbol", T.LongType()), T.StructField("n", T.LongType()),
    ])
    for seed in range(100):

        def work(seed: int = seed):
            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                found = read_words(batch, seed)
                language = pa.array(found.languages, pa.string()).take(pa.array(found.language))
                n = np.bincount(found.word, minlength=len(found.texts))
                return pa.RecordBatch.from_arrays([language, pa.array(found.texts, pa.string()), pa.array(found.symbols.view(np.int64)), pa.array(n)], names=schema.names)

            return step

        counted = settle(map_texts(df, work, schema).groupBy("lang", "word", "symbol").agg(F.sum("n").alias("n")))
        twice = counted.groupBy("symbol").agg(F.count("*").alias("words")).where("words > 1")
        if not twice.limit(1).count():
            return counted, seed
    raise RuntimeError("no seed gives all words different symbols")  # never by chance


def keeps(symbols: np.ndarray | None) -> Callable[[np.ndarray], np.ndarray]:
    """Which symbols are among the given sorted ones; all if there are none."""
    if symbols is None:
        return lambda wanted: np.ones(len(wanted), bool)
    if not len(symbols):
        return lambda wanted: np.zeros(len(wanted), bool)
    return lambda wanted: symbols[np.minimum(np.searchsorted(symbols, wanted), len(symbols) - 1)] == wanted


@dataclass(frozen=True)
class PairBits:
    """One bit for each leading part of a digest: whether a frequent pair has it."""

    bits: int
    table: np.ndarray

    def has(self, digests: np.ndarray) -> np.ndarray:
        at = digests >> np.uint64(64 - self.bits)
        return (self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def runs_of(batch: pa.RecordBatch, seed: int, kept: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted symbols of the kept words of a batch, the words as indices into them, and where runs within pieces begin."""
    found = read_words(batch, seed)
    used = kept(found.symbols)
    at = np.flatnonzero(used[found.word]) if len(found.word) else np.zeros(0, np.int64)
    order = np.flatnonzero(used)
    order = order[np.argsort(found.symbols[order])]
    index = np.zeros(len(used), np.int64)
    index[order] = np.arange(len(order))
    piece = found.piece[at]
    breaks = np.append(True, (np.diff(at) > 1) | (np.diff(piece) != 0))[: len(at)]
    return found.symbols[order], index[found.word[at]], breaks


def pairs_in(symbols: np.ndarray, word: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Second words of the neighbours within runs; digests of the distinct pairs, which each is, and how often they occur."""
    at = np.flatnonzero(~breaks)
    keys, which, n = np.unique(word[at - 1] * max(len(symbols), 1) + word[at], return_inverse=True, return_counts=True)
    first, second = (symbols[k] for k in np.divmod(keys, max(len(symbols), 1)))
    return at, mix64(mix64(first) + second), which.reshape(-1), n


def grams_of(batch: pa.RecordBatch, seed: int, kept: Callable[[np.ndarray], np.ndarray], pairs: PairBits) -> ca.Grams:
    """All n-grams of kept words and kept pairs within the pieces of a batch, and the kept words themselves."""
    symbols, word, breaks = runs_of(batch, seed, kept)
    at, digests, which, _ = pairs_in(symbols, word, breaks)
    breaks = breaks.copy()
    breaks[at] = ~pairs.has(digests)[which]
    return ca.from_runs(symbols, word, np.cumsum(breaks))


def frequent_pairs(df: DataFrame, seed: int, sent, least: int, most_bits: int = PAIR_BITS) -> PairBits:
    """Which neighbouring words occur together at least ``least`` times; a few others may pass."""
    bounded_batches(df.sparkSession)
    schema = T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])

    def added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pair, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
        return pair[first], np.add.reduceat(n, first) if len(first) else n

    def rows(made: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(made[0].view(np.int64)), pa.array(made[1])], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, waiting, last = None, [], 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                kept = kept or keeps(sent.value)
                _, digests, _, n = pairs_in(*runs_of(piece, seed, kept))
                held.append((digests, n))
                waiting += len(n)
                if waiting > last + HELD_PAIRS:
                    held = [added(held)]
                    waiting = last = len(held[0][1])
                    if waiting > 2 * HELD_PAIRS:
                        yield rows(held[0])
                        held, waiting, last = [], 0, 0
        if held:
            yield rows(added(held))

    often = settle(df.mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("pair"))
    bits = min(most_bits, max(16, (often.count() * BITS_PER_PAIR).bit_length()))
    part_bits = min(bits, 15)  # the table is made in parts of 4 KB at least
    digest = T.StructType([T.StructField("part", T.LongType()), T.StructField("bytes", T.BinaryType())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in groups(batches, "part"):
            table = np.zeros(1 << part_bits, bool)
            for batch in held:
                at = batch.column("pair").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
                table[(at & np.uint64((1 << part_bits) - 1)).astype(np.int64)] = True
            packed = np.packbits(table, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([packed], pa.binary())], names=digest.names)

    part = F.shiftrightunsigned("pair", 64 - bits + part_bits) if bits > part_bits else F.lit(0)
    placed = often.select(part.cast("long").alias("part"), "pair").repartition("part").sortWithinPartitions("part")
    table = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (part_bits - 3)
    for r in placed.mapInArrow(parts, digest).collect():  # at most 1 << (PAIR_BITS - 3) bytes
        table[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bytes"], np.uint8)
    return PairBits(bits, table)


RANGES = T.StructType([T.StructField("range", T.LongType()), T.StructField("automaton", T.BinaryType())])


def bounds_of(df: DataFrame, seed: int, words: int, ranges: int, sent, pairs) -> np.ndarray:
    """Sorted bounds of prefix ranges with about equally many n-grams, from a sample of the documents."""
    wanted = max(SAMPLE_WORDS, 4 * KEYS_PER_RANGE * ranges)
    rate = min(1.0, wanted / max(words, 1))
    every = np.uint64(max(1, int(2 * words * rate) // (KEYS_PER_RANGE * ranges)))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in NAMES])
    sample = df.where(F.pmod(F.xxhash64("text", F.lit("bounds")), F.lit(1 << 40)) < int(rate * (1 << 40)))

    def work():
        kept = keeps(sent.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            grams = grams_of(batch, seed, kept, PairBits(*pairs.value))
            chosen = [grams.sequences(k + 1, np.flatnonzero(h % every == 0)) for k, h in enumerate(grams.hashes())]
            keys = np.concatenate(chosen).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys[:, k].copy()) for k in range(ca.LONGEST)], names=NAMES)

        return step

    found = map_texts(sample, work, schema).toArrow()  # about KEYS_PER_RANGE rows for each range
    keys = np.stack([found.column(n).to_numpy().astype(np.int64) for n in NAMES], axis=1).view(np.uint64)
    keys = keys[np.lexsort(keys.T[::-1])]
    if not len(keys):
        return np.zeros((0, ca.LONGEST), np.uint64)
    return np.unique(keys[np.arange(1, ranges) * len(keys) // ranges], axis=0)


def shards(df: DataFrame, seed: int, sent, pairs, bounds) -> DataFrame:
    """Automata of each task's n-grams, cut into prefix ranges."""
    bounded_batches(df.sparkSession)

    def rows(held: list[ca.Grams]) -> pa.RecordBatch:
        pieces = ca.cut(ca.union(held), bounds.value)
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in pieces], pa.int64()), pa.array([ca.pack(g) for _, g in pieces], pa.binary())], names=RANGES.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, nodes, last = None, [], 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                kept = kept or keeps(sent.value)
                held.append(grams_of(piece, seed, kept, PairBits(*pairs.value)))
                nodes += len(held[-1])
                if nodes > last + HELD_NODES:
                    held = [ca.union(held)]
                    nodes = last = len(held[0])
                    if nodes > HELD_NODES:
                        yield rows(held)
                        held, nodes, last = [], 0, 0
        if held:
            yield rows(held)

    return df.mapInArrow(run, RANGES)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Slices of batches that are sorted by ``key``, one value at a time, each as soon as the next one begins."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = batch.column(key).to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])), len(values)) if len(values) else []
        for a, b in zip(edges[:-1], edges[1:]):
            if current is not None and values[a] != current:
                yield current, held
                held = []
            current = values[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, held


def frequent(parts: DataFrame, least: int, width: int) -> DataFrame:
    """One automaton for each prefix range: the sums of its parts, without counts below ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, nodes, last = None, [], 0, 0

        def done() -> pa.RecordBatch:
            total = ca.pruned(ca.union(held), least)
            alive = [(current, ca.pack(total))] if len(total) else []
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in alive], pa.int64()), pa.array([g for _, g in alive], pa.binary())], names=RANGES.names)

        for batch in batches:
            for r, data in zip(batch.column("range").to_pylist(), batch.column("automaton").to_pylist()):
                if current is not None and r != current:
                    yield done()
                    held, nodes, last = [], 0, 0
                current = r
                held.append(ca.unpack(data))
                nodes += len(held[-1])
                if nodes > last + HELD_NODES:  # what is equal has met, before more is unpacked
                    held = [ca.union(held)]
                    nodes = last = len(held[0])
        if held:
            yield done()

    dealt = parts.repartition(width, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, RANGES)


@dataclass(frozen=True)
class Parts:
    """The phrases of one range (two words or more) and the parts whose counts they need, each part once."""

    phrases: np.ndarray  # sequences
    count: np.ndarray
    length: np.ndarray
    wanted: np.ndarray  # sequences of the parts
    first: list[np.ndarray]  # for each cut k: which part the first k words are
    rest: list[np.ndarray]  # and the rest
    middle: np.ndarray  # second and third word of four


def parts_of(grams: ca.Grams) -> Parts:
    found, count, length = [], [], []
    for n in range(2, ca.LONGEST + 1):
        own = np.flatnonzero(grams.levels[n - 1].weight > 0)
        found.append(grams.sequences(n, own))
        count.append(grams.levels[n - 1].weight[own])
        length.append(np.full(len(own), n))
    phrases, count, length = np.concatenate(found), np.concatenate(count), np.concatenate(length)
    sections = []
    for k in range(1, ca.LONGEST):
        left, right = phrases.copy(), np.zeros_like(phrases)
        left[:, k:] = 0
        right[:, : ca.LONGEST - k] = phrases[:, k:]
        sections += [left, right]
    middle = np.zeros_like(phrases)
    middle[:, :2] = phrases[:, 1:3]
    sections.append(middle)
    all_ = np.concatenate(sections)
    wanted, which = distinct_rows(all_)
    pieces = np.split(which, len(sections))
    return Parts(phrases, count, length, wanted, pieces[0:-1:2], pieces[1:-1:2], pieces[-1])


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    fresh = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))[: len(rows)]
    which = np.empty(len(rows), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return ordered[fresh], which


def exact(a: np.ndarray, factor: int) -> np.ndarray:
    """``a * factor`` without overflow: as Python numbers where 64 bits do not hold it."""
    return a * factor if not len(a) or int(a.max()) < (1 << 62) // factor else a.astype(object) * factor


def scores(parts: Parts, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each phrase at its lowest-scoring cut (the first of equals): counts of both parts and the score."""
    left, right = np.zeros(len(parts.count), np.int64), np.zeros(len(parts.count), np.int64)
    best = np.full(len(parts.count), np.iinfo(np.int64).max)
    top = exact(parts.count, SCALE)
    for k in range(1, ca.LONGEST):
        cut = np.flatnonzero(parts.length > k)
        l, r = counts[parts.first[k - 1][cut]], counts[parts.rest[k - 1][cut]]
        score = (top[cut] // (l + r)).astype(np.int64)
        better = score < best[cut]
        best[cut[better]], left[cut[better]], right[cut[better]] = score[better], l[better], r[better]
    return left, right, best


def inside(parts: Parts, counts: np.ndarray) -> np.ndarray:
    """Sequences of the shorter phrases that go, because a phrase of this range around them is nearly as frequent."""
    many, few = INSIDE_SHARE
    out = [np.zeros(0, np.int64)]
    for section, long in [
        *[(parts.first[k - 1], k + 1) for k in range(2, ca.LONGEST)],
        *[(parts.rest[k - 1], k + 2) for k in range(1, ca.LONGEST - 1)],
        (parts.middle, ca.LONGEST),
    ]:
        at = np.flatnonzero(parts.length >= long)
        at = at[exact(parts.count[at], many) >= exact(counts[section[at]], few)]
        out.append(section[at])
    return parts.wanted[np.unique(np.concatenate(out))]


def scored(ranges: DataFrame, bounds, width: int) -> DataFrame:
    """Phrases with the counts of their parts (``kind`` 0), and phrases that go because they lie inside others (1)."""
    asked = T.StructType([T.StructField(n, T.LongType()) for n in ("range", "source", "part", *NAMES)])
    answered = T.StructType([T.StructField(n, T.LongType()) for n in ("range", "part", "n")])
    out = T.StructType([T.StructField("kind", T.IntegerType())] + [T.StructField(n, T.LongType()) for n in (*NAMES, "a", "l", "r", "score")])

    def signed(rows: np.ndarray) -> list[pa.Array]:
        return [pa.array(rows[:, k].copy().view(np.int64)) for k in range(ca.LONGEST)]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, data in zip(batch.column("range").to_pylist(), batch.column("automaton").to_pylist()):
                wanted = parts_of(ca.unpack(data)).wanted
                target = ca.range_of(wanted, bounds.value)
                columns = [pa.array(target), pa.array(np.full(len(wanted), r)), pa.array(np.arange(len(wanted))), *signed(wanted)]
                yield pa.RecordBatch.from_arrays(columns, names=asked.names)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, grams = None, ca.EMPTY
        for r, held in groups(batches, "range"):
            for batch in held:
                own = batch.filter(pc.is_valid(batch.column("automaton")))
                if own.num_rows:
                    current, grams = r, ca.unpack(own.column("automaton")[0].as_py())
                rows = batch.filter(pc.is_null(batch.column("automaton")))
                wanted = np.stack([rows.column(n).to_numpy() for n in NAMES], axis=1).astype(np.int64).view(np.uint64)
                counts = ca.look_up(grams if current == r else ca.EMPTY, wanted)
                yield pa.RecordBatch.from_arrays([rows.column("source"), rows.column("part"), pa.array(counts)], names=answered.names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in groups(batches, "range"):
            rows = pa.Table.from_batches(held).combine_chunks()
            automata = rows.column("automaton").drop_null()
            if not len(automata):
                continue
            parts = parts_of(ca.unpack(automata[0].as_py()))
            given = rows.filter(pc.is_null(rows.column("automaton")))
            counts = np.zeros(len(parts.wanted), np.int64)
            counts[given.column("part").to_numpy()] = given.column("n").to_numpy()
            left, right, score = scores(parts, counts)
            gone = inside(parts, counts)
            none = pa.nulls(len(gone), pa.int64())
            numbers = [pa.array(x) for x in (parts.count, left, right, score)]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(left), np.int32)), *signed(parts.phrases), *numbers], names=out.names)
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(gone), np.int32)), *signed(gone), none, none, none, none], names=out.names)

    def with_automata(rows: DataFrame) -> DataFrame:
        """Rows behind the automaton of their range."""
        both = ranges.unionByName(rows, allowMissingColumns=True)
        return both.repartition(width, "range").sortWithinPartitions("range", F.col("automaton").isNull())

    answers = with_automata(ranges.mapInArrow(ask, asked)).mapInArrow(answer, answered)
    return with_automata(answers).mapInArrow(judge, out)


def rank(found: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The best phrases of each language with their texts; ``words`` holds the words of frequent phrases and ``total``, all of a language."""
    phrases = found.where("kind = 0").join(found.where("kind = 1").select(*NAMES), NAMES, "left_anti")
    placed = phrases.join(words.select(F.col("symbol").alias("w1"), "lang", "total"), "w1")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # All ties at the end stay until they can be ordered by their texts.
    likely = settle(placed.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place"))
    spelled = (
        likely.select(*NAMES, F.posexplode(F.array(*NAMES)).alias("at", "symbol")).where("symbol <> 0")
        .join(words.select("symbol", "word"), "symbol").groupBy(*NAMES)
        .agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])).alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        likely.join(spelled, NAMES).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT, top: int = TOP,
    max_words: int = MAX_WORDS, pair_bits: int = PAIR_BITS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of both parts), ``n`` (words of the language), ``score``."""
    spark = df.sparkSession
    df, width = prepared(df, text, lang), shuffle_partitions(spark)
    counted, seed = count_words(df)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    often = counted.where(F.col("n") >= least)
    words = int(counted.agg(F.sum("n")).first()[0] or 0)
    few = often.limit(max_words + 1).count() <= max_words
    symbols = np.sort(often.select("symbol").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)) if few else None
    sent = spark.sparkContext.broadcast(symbols)  # at most max_words numbers
    bits = frequent_pairs(df, seed, sent, least, pair_bits)
    pairs = spark.sparkContext.broadcast((bits.bits, bits.table))  # at most 2 ** pair_bits bits
    ranges = int(min(MAX_RANGES, max(width, words // WORDS_PER_RANGE)))
    bounds = spark.sparkContext.broadcast(bounds_of(df, seed, words, ranges, sent, pairs))  # at most MAX_RANGES n-grams
    automata = settle(frequent(shards(df, seed, sent, pairs, bounds), least, width))
    found = settle(scored(automata, bounds, width))
    return rank(found, often.join(totals, "lang"), top)
