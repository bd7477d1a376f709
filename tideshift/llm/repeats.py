"""Removing repeated passages by maximal repeats from suffix arrays with common-prefix interval trees.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a smaller id. The suffixes
of all documents are dealt out by content: among the k-mers of each string of ``length`` bytes, the one with the smallest
hash (the first of equals) is its anchor, so equal strings have the same anchor, wherever they stand, and meet in one
bucket. Each bucket holds, for every place of the anchor, the segment of text whose strings have it.

1. Documents with equal texts are found by digests: all but the smallest id go whole, and only that one goes on.
2. Anchors that occur in two documents or tasks set bits in a filter of fixed size, which is sent to all tasks; of those
   that pass, the longer strings on either side of the anchor do the same. Other segments can't repeat and are not dealt
   out. Filters also tell later copies (step 1) and, at the end, the documents without spans, so their texts are not
   shuffled. A full filter lets more through and changes no result.
3. A task that sees a segment again under a larger id settles it at once, so a passage in a third of all documents
   reaches its bucket once per task, not once per document.
4. In a bucket, the suffixes that share their first ``length`` bytes are classes; a class whose members all have the same
   byte before them is left to the one before it. The rest is sorted into a suffix array with common-prefix lengths, and
   a stack scan over it walks the tree of common-prefix intervals. An interval that has different bytes (or a border)
   on the left is a maximal repeat: all its occurrences but those of its smallest id give spans to remove.
5. Spans are put together by document and cut out of the texts.

Missing texts are empty. A missing id counts as larger than every other, and equal ids are not smaller than each other,
so rows that repeat with their id stay alike. Strings never cross documents. All strings are judged on the input.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import bounded_batches, map_texts, mix64, slices, utf8
from tideshift.session import settle

LENGTH = 50
ANCHOR = 20
LAST_ID = (1 << 63) - 1  # stands for a missing id
BUCKET_BITS = 12
FILTER_BITS = 27  # bits of a filter, as a power of two: 16 MB
HELD_ANCHORS = 2_000_000
KNOWN_SEGMENTS = 500_000
BUCKET_ROWS = 100_000  # segments that are worked on together, rounded up to whole anchors
BASE = 0x9E3779B97F4A7C15


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` bytes, by doubling."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part = mix64(np.arange(1, 257, dtype=np.uint64))[data]
    size, made, have = 1, None, 0
    while True:
        if length & size:
            if made is None:
                made, have = part, size
            else:
                m = len(data) - have - size + 1
                made = made[:m] * np.uint64(pow(BASE, size, 1 << 64)) + part[have : have + m]
                have += size
        if size * 2 > length:
            return mix64(made[:n])
        part = part[: len(part) - size] * np.uint64(pow(BASE, size, 1 << 64)) + part[size:]
        size *= 2


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = pick(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Segments:
    """Segments of a batch of texts: row, first string, number of strings, place of the anchor, and its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, k: int):
        width = length - k + 1
        self.length, self.k = length, k
        self.row = self.start = self.count = self.anchor = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        if len(data) < length:
            return
        hashes = rolling(data, k)
        low = _slide(hashes, width, np.minimum)  # of the string that starts at each place
        # A k-mer can be an anchor if it is the smallest of some string around it.
        padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
        places = np.flatnonzero(hashes == _slide(padded, width, np.maximum))
        upto = np.zeros(len(hashes) + 1, np.int64)
        upto[places + 1] = 1
        upto = np.cumsum(upto)
        sizes = np.diff(offsets)
        strings = np.maximum(sizes - length + 1, 0)
        row = np.repeat(np.arange(len(sizes)), strings)
        first = np.cumsum(strings) - strings
        at = np.repeat(offsets[:-1] - first, strings) + np.arange(len(row))  # strings that stay in their text
        own = upto[at]
        open_ = np.arange(len(at))
        while len(open_):
            wrong = hashes[places[own[open_]]] != low[at[open_]]
            open_ = open_[wrong]
            own[open_] += 1
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        self.row, self.start = row[begin], at[begin]
        self.count = np.diff(np.append(begin, len(at)))
        self.anchor = places[own[begin]]
        self.hash = hashes[self.anchor]

    def sides(self, data: np.ndarray, offsets: np.ndarray, which: np.ndarray):
        """Hashes of the strings that reach from an anchor half of the rest to the left and to the right, and which exist.

        Equal strings of the full length that share an anchor share one of the two.
        """
        width = self.k + (self.length - self.k + 1) // 2
        hashes = rolling(data, width)
        row, anchor = self.row[which], self.anchor[which]
        out = []
        for start in (anchor + self.k - width, anchor):
            there = (start >= offsets[row]) & (start + width <= offsets[row + 1])
            out.append((hashes[np.where(there, start, 0)] if len(hashes) else np.zeros(len(row), np.uint64), there))
        return out


# ---------------------------------------------------------------- filters of fixed size


def _bit_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each hash and two bit places within the bucket's part of a filter."""
    inside = bits - BUCKET_BITS
    mask = np.uint64((1 << inside) - 1)
    return (
        (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32),
        (hashes & mask).astype(np.int64),
        ((hashes >> np.uint64(inside)) & mask).astype(np.int64),
    )


def _part(hashes: np.ndarray, bits: int) -> bytes:
    """The bits that hashes of one bucket set in its part."""
    part = np.zeros(1 << (bits - BUCKET_BITS), bool)
    _, one, two = _bit_places(hashes, bits)
    part[one] = part[two] = True
    return np.packbits(part).tobytes()


def passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may have been put into the filter; all that were do."""
    bits = BUCKET_BITS + int(filter_.shape[1] * 8).bit_length() - 1
    bucket, one, two = _bit_places(hashes, bits)
    bit = lambda p: (filter_[bucket, p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1
    return (bit(one) & bit(two)).astype(bool)


def send(spark: SparkSession, filter_: np.ndarray) -> Broadcast:
    """A filter for all tasks, compressed: one that holds little is small."""
    return spark.sparkContext.broadcast((zlib.compress(filter_.tobytes(), 1), filter_.shape))


def opened(sent: Broadcast) -> np.ndarray:
    raw, shape = sent.value
    return np.frombuffer(zlib.decompress(raw), np.uint8).reshape(shape)


PART = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def _assembled(parts: DataFrame, bits: int) -> np.ndarray:
    """The filter from one row for each bucket: the same few megabytes whatever the size of the input."""
    made = np.zeros((1 << BUCKET_BITS, (1 << (bits - BUCKET_BITS)) // 8), np.uint8)
    for row in parts.collect():
        made[row["bucket"]] |= np.frombuffer(row["bits"], np.uint8)
    return made


def filter_of(hashes: DataFrame, bits: int, column: str = "h") -> np.ndarray:
    """A filter that holds the 64-bit hashes of a column."""
    bucket = F.shiftrightunsigned(column, 64 - BUCKET_BITS).cast("int").alias("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, values = batch.column("bucket").to_numpy(), batch.column("h").to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(own[a]) for a, _ in spans], pa.int32()), pa.array([_part(values[a:b], bits) for a, b in spans], pa.binary())],
                names=PART.names,
            )

    rows = hashes.select(bucket, F.col(column).alias("h"))
    # A bucket may come in several batches; its parts are put together by the driver.
    return _assembled(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, PART), bits)


def _kept(piece: pa.RecordBatch, copies: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """Without rows that are known to be later copies: their text has copies and they are not its first row."""
    text, row = (piece.column(n).to_numpy().view(np.uint64) for n in ("ht", "hr"))
    keep = ~passes(copies[0], text) | passes(copies[1], row)
    return piece if keep.all() else piece.filter(pa.array(keep))


def copy_filters(first: DataFrame, bits: int) -> tuple[Broadcast, Broadcast]:
    """Filters of the texts that have copies, and of the first rows of all texts that the former lets through.

    A first row always passes both, so none is taken for a copy.
    """
    spark = first.sparkSession
    texts = send(spark, filter_of(first.where("n > 1").select(F.col("ht").alias("h")), bits))
    schema = T.StructType([T.StructField("h", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = opened(texts)
        for batch in batches:
            hit = passes(marks, batch.column("ht").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("hr").filter(pa.array(hit))], names=["h"])

    return texts, send(spark, filter_of(first.select("ht", "hr").mapInArrow(run, schema), bits))


def _repeated(hashed: DataFrame, bits: int) -> np.ndarray:
    """The filter of hashes that occur in more than one document, from packed rows (``bucket``, ``hashes``, ``again``)."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashes, again = None, [], []

        def rows() -> pa.RecordBatch:
            wide = np.zeros((sum(map(len, hashes)), 8), np.uint8)
            wide[:, :6] = np.concatenate(hashes)
            values = wide.view("<u8").ravel()
            distinct, counts = np.unique(values, return_counts=True)
            keep = np.concatenate([distinct[counts > 1], values[np.concatenate(again)]])
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_part(keep, bits)], pa.binary())], names=PART.names)

        for batch in batches:
            for bucket, one, two in zip(*[batch.column(n).to_pylist() for n in ("bucket", "hashes", "again")]):
                if bucket != now and hashes:
                    yield rows()
                    hashes, again = [], []
                now = bucket
                raw = np.frombuffer(one, np.uint8).reshape(-1, 6)
                hashes.append(raw)
                again.append(np.unpackbits(np.frombuffer(two, np.uint8), count=len(raw)).astype(bool))
        if hashes:
            yield rows()

    return _assembled(hashed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(marked, PART), bits)


HASHED = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("hashes", T.BinaryType()), T.StructField("again", T.BinaryType()),
])


def _packed(parts) -> pa.RecordBatch:
    """Distinct hashes by bucket, each with whether several documents of these parts have it."""
    hashes, docs = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((docs, hashes))
    hashes, docs = hashes[order], docs[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    last = np.append(first[1:], len(hashes)) - 1
    again, hashes = docs[first] != docs[last], hashes[first]
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(cuts[1:], len(bucket))
    # Six bytes of a hash suffice within its bucket; a chance meeting only costs a look.
    raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts]), pa.array([raw[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
         pa.array([np.packbits(again[a:b]).tobytes() for a, b in zip(cuts, ends)], pa.binary())], names=HASHED.names,
    )


def repeated_hashes(texts: DataFrame, copies, length: int, k: int, bits: int, anchors: Broadcast | None = None) -> Broadcast:
    """The filter of repeated anchors, or with it that of the longer strings on the sides of anchors that pass it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tuple(map(opened, copies))
        marks = opened(anchors) if anchors is not None else None
        parts, held = [], 0
        for batch in batches:
            for piece in slices(batch, "text") if batch.num_rows else ():
                piece = _kept(piece, known)
                data, offsets = utf8(piece.column("text"))
                found = Segments(data, offsets, length, k)
                docs = piece.column("doc").to_numpy()[found.row]
                hashes = found.hash
                if marks is not None:
                    near = np.flatnonzero(passes(marks, hashes))
                    (left, has_left), (right, has_right) = found.sides(data, offsets, near)
                    hashes = np.concatenate([left[has_left], right[has_right]])
                    docs = np.concatenate([docs[near][has_left], docs[near][has_right]])
                if len(hashes):
                    parts.append((hashes, docs))
                    held += len(hashes)
                if held > HELD_ANCHORS:
                    yield _packed(parts)
                    parts, held = [], 0
        if held:
            yield _packed(parts)

    bounded_batches(texts.sparkSession)
    return send(texts.sparkSession, _repeated(texts.select("doc", "ht", "hr", "text").mapInArrow(run, HASHED), bits))


# ---------------------------------------------------------------- segments and buckets

SEGMENT = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("t1", T.LongType()), T.StructField("t2", T.LongType()),
    T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("bytes", T.BinaryType()),
])
SPAN = T.StructType([SEGMENT[n] for n in ("doc", "t1", "t2", "start", "size")])


def segments(texts: DataFrame, copies, sides: Broadcast, length: int, k: int) -> DataFrame:
    """Segments with a side that passes the filter; those settled in their task have no ``bytes`` and are spans already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks = tuple(map(opened, copies)), opened(sides)
        least: dict[bytes, int] = {}  # smallest id seen with a segment, by digest
        for batch in batches:
            for piece in slices(batch, "text") if batch.num_rows else ():
                piece = _kept(piece, known)
                data, offsets = utf8(piece.column("text"))
                found = Segments(data, offsets, length, k)
                if not len(found.hash):
                    continue
                (left, has_left), (right, has_right) = found.sides(data, offsets, np.arange(len(found.hash)))
                keep = np.flatnonzero((has_left & passes(marks, left)) | (has_right & passes(marks, right)))
                if not len(keep):
                    continue
                row, start, count = found.row[keep], found.start[keep], found.count[keep]
                docs = piece.column("doc").to_numpy()[row].tolist()
                raw = data.tobytes()
                if len(least) > KNOWN_SEGMENTS:
                    least = {}
                made: list[bytes | None] = []
                for doc, a, n in zip(docs, start.tolist(), (count + length - 1).tolist()):
                    own = raw[a : a + n]
                    digest = hashlib.blake2b(own, digest_size=16).digest()
                    seen = least.get(digest)
                    if seen is not None and seen < doc:
                        made.append(None)
                    else:
                        least[digest] = doc
                        made.append(own)
                # What is settled needs no bucket; it is dealt out evenly instead of by its anchor.
                done = np.array([m is None for m in made])
                spread = mix64(piece.column("hr").to_numpy().view(np.uint64)[row] + start.astype(np.uint64))
                bucket = np.where(done, spread, found.hash[keep])
                picked = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64)), *[piece.column(n).take(picked) for n in ("doc", "t1", "t2")],
                     pa.array((start - offsets[row]).astype(np.int32)), pa.array((count + length - 1).astype(np.int32)),
                     pa.array(made, pa.binary())], names=SEGMENT.names,
                )

    bounded_batches(texts.sparkSession)
    return texts.select("doc", "t1", "t2", "ht", "hr", "text").mapInArrow(run, SEGMENT)


def interval_tree(lcp: list[int], docs: list[int], before: list[int]) -> Iterator[tuple[int, list[int]]]:
    """Maximal repeats of a suffix array: common-prefix length and the occurrences that have a smaller id beside them.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i (0 where a class starts), ``docs`` their ids, and ``before``
    the byte left of each (-1 at a border, which differs from everything). Every occurrence is given once, with the longest
    of its intervals that has a smaller id; occurrences in intervals with one byte on the left are handed to the parents.
    """
    n = len(docs)
    # An open interval: common prefix, smallest id, the byte on the left (-1 for different ones), occurrences left over.
    stack: list[list] = []
    for i in range(n + 1):
        here = lcp[i] if i < n else 0
        last = [None, docs[i - 1], before[i - 1], [i - 1]] if i else None
        while stack and stack[-1][0] > here:
            top = stack.pop()
            if last is not None:
                _join(top, last)
            if top[2] == -1:
                least = top[1]
                out = [x for x in top[3] if docs[x] > least]
                if out:
                    yield top[0], out
                    top[3] = [x for x in top[3] if docs[x] == least]
            last = top
        if here and i < n:
            if stack and stack[-1][0] == here:
                _join(stack[-1], last)
            else:
                stack.append([here, *last[1:]])


def _join(parent: list, child: list) -> None:
    parent[1] = min(parent[1], child[1])
    if parent[2] != child[2]:
        parent[2] = -1
    if len(parent[3]) < len(child[3]):
        parent[3], child[3] = child[3], parent[3]
    parent[3].extend(child[3])


def repeats_of(data: np.ndarray, bounds: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans to remove from segments: segment, first byte in it, and number of bytes.

    Suffixes of all segments that start at least ``length`` bytes before their end are sorted as described above.
    """
    sizes = np.diff(bounds)
    strings = sizes - length + 1
    segment = np.repeat(np.arange(len(sizes)), strings)
    at = np.repeat(bounds[:-1] - (np.cumsum(strings) - strings), strings) + np.arange(strings.sum())
    hashes = rolling(data, length)[at]
    # Classes of equal strings.
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    first = np.flatnonzero(new)
    doc = docs[segment[order]]
    several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    inner = at[order] > bounds[segment[order]]
    byte = np.where(inner, data[np.maximum(at[order] - 1, 0)].astype(np.int64), -1)
    low, high = np.minimum.reduceat(byte, first), np.maximum.reduceat(byte, first)
    diverse = (low != high) | (low == -1)
    keep = np.repeat(several & diverse, np.diff(np.append(first, len(order))))
    order, byte = order[keep], byte[keep]
    if not len(order):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    # The suffix array: by class, then by what follows the shared bytes up to the end of the segment.
    at, segment = at[order], segment[order]
    rest = bounds[segment + 1] - at - length
    words = -(-int(rest.max()) // 8)
    padded = np.concatenate([data, np.zeros(8 * words + 8, np.uint8)])
    columns = []
    for w in range(words):
        column = np.zeros(len(at), np.uint64)
        for b in range(8):
            inside = 8 * w + b < rest
            byte_at = padded[at + length + 8 * w + b]
            column = (column << np.uint64(8)) | np.where(inside, byte_at, 0).astype(np.uint64)
        columns.append(column)
    by = np.lexsort((rest, *reversed(columns), hashes[order]))
    at, segment, rest, byte, key = at[by], segment[by], rest[by], byte[by], hashes[order][by]
    # Common prefixes of neighbours.
    shared = np.zeros(len(at) - 1, np.int64)
    going = np.ones(len(at) - 1, bool)
    for column in columns:
        column = column[by]
        differ = column[1:] ^ column[:-1]
        zero = differ == 0
        lead = np.zeros(len(differ), np.int64)
        for b in range(8):
            lead += (differ >> np.uint64(56 - 8 * b)) == 0
        shared += np.where(going, lead, 0)
        going &= zero
    shared = length + np.minimum(shared, np.minimum(rest[1:], rest[:-1]))
    lcp = np.concatenate([[0], np.where(key[1:] == key[:-1], shared, 0)])
    found, sizes_ = [], []
    for size, members in interval_tree(lcp.tolist(), docs[segment].tolist(), byte.tolist()):
        found += members
        sizes_ += [size] * len(members)
    found = np.array(found, np.int64)
    return segment[found], at[found] - bounds[segment[found]], np.array(sizes_, np.int64)


def merged(keys: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each key joined where they overlap or touch; the result is sorted."""
    order = np.lexsort((start, keys))
    keys, start, stop = keys[order], start[order], (start + size)[order]
    wide = int(stop.max()) + 1 if len(stop) else 1
    group = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])]) if len(keys) else keys
    reach = np.maximum.accumulate(stop + group * wide) - group * wide
    new = np.ones(len(keys), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keys)) - 1
    return keys[first], start[first], reach[last] - start[first]


def bucket_spans(dealt: DataFrame, length: int) -> DataFrame:
    """Spans of all segments, bucket by bucket."""

    def work(table: pa.Table) -> pa.RecordBatch:
        settled = np.asarray(table.column("bytes").is_null())
        open_ = table.filter(pa.array(~settled)).combine_chunks()
        column = open_.column("bytes")
        data, bounds = utf8(pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary()))
        done = np.flatnonzero(settled)
        where = np.flatnonzero(~settled)
        parts = [(done, np.zeros(len(done), np.int64), table.column("size").to_numpy()[done].astype(np.int64))]
        if len(where):
            docs = open_.column("doc").to_numpy()
            segment, at, size = repeats_of(data, bounds, docs, length)
            parts.append((where[segment], at, size))
        row, at, size = (np.concatenate(x) for x in zip(*parts))
        start = at + table.column("start").to_numpy()[row]
        # Join what overlaps within a text before it is dealt out again.
        texts = np.stack([table.column(n).to_numpy() for n in ("doc", "t1", "t2")])[:, row]
        _, pick, text = np.unique(texts, axis=1, return_index=True, return_inverse=True)
        text, start, size = merged(text.ravel(), start, size)
        rows = pa.array(row[pick][text])
        return pa.RecordBatch.from_arrays(
            [*[table.column(n).combine_chunks().take(rows) for n in ("doc", "t1", "t2")], pa.array(start.astype(np.int32)),
             pa.array(size.astype(np.int32))], names=SPAN.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count > BUCKET_ROWS:
                table = pa.Table.from_batches(held)
                anchors = table.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on
                if cut:
                    yield work(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    count = len(table) - cut
        if held:
            yield work(pa.Table.from_batches(held))

    bounded_batches(dealt.sparkSession)
    return dealt.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, SPAN)


def cut_out(texts: DataFrame, spans: DataFrame, bits: int) -> DataFrame:
    """``doc``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) of each row.

    Only rows that may have spans, by a filter of fixed size, are joined; the others stay where they are.
    """
    keys = ["doc", "t1", "t2"]
    marks = filter_of(spans.select(*keys).distinct().select(F.xxhash64(*keys).alias("h")), bits)
    sent = send(texts.sparkSession, marks)

    @F.pandas_udf(T.BooleanType())
    def may_have(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        marks = opened(sent)
        for hr in parts:
            yield pd.Series(passes(marks, hr.to_numpy().view(np.uint64)))

    bounded_batches(texts.sparkSession)
    marked = texts.withColumn("near", may_have("hr"))
    whole = marked.where(~F.col("near")).select(
        "doc", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"),
    )
    listed = spans.groupBy(*keys).agg(F.collect_list(F.struct("start", "size")).alias("s"))  # no more than a text has room for
    packed = listed.select(*keys, F.col("s.start").alias("starts"), F.col("s.size").alias("sizes"))
    joined = marked.where("near").select(*keys, "text").join(packed, keys, "left")
    schema = T.StructType([
        texts.schema["doc"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType()),
    ])

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = utf8(batch.column("text"))
            starts, sizes = batch.column("starts"), batch.column("sizes")
            row = np.repeat(np.arange(batch.num_rows), starts.value_lengths().fill_null(0).to_numpy())
            row, at, size = merged(row, starts.flatten().to_numpy().astype(np.int64), sizes.flatten().to_numpy().astype(np.int64))
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, at + offsets[row], 1)
            np.add.at(change, at + offsets[row] + size, -1)
            gone = np.cumsum(change)[:-1] > 0
            upto = np.concatenate([[0], np.cumsum(gone)])
            removed = np.diff(upto[offsets])
            kept = data[~gone].tobytes()
            bounds = (offsets - upto[offsets]).tolist()
            return pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(np.diff(offsets)), pa.array(removed), pa.array(np.bincount(row, minlength=batch.num_rows)),
                 pa.array([kept[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary())], names=schema.names,
            )

        return step

    return whole.unionByName(map_texts(joined.select("doc", "text", "starts", "sizes"), work, schema))


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = ANCHOR, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """Every row's id with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the remaining bytes."""
    if not 0 < k <= length:
        raise ValueError("the anchor must fit into a string")
    body = F.coalesce(F.col(text), F.lit(""))
    texts = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(body).alias("t1"),
        F.xxhash64(F.lit(7), body).alias("t2"),  # both together are the text's identity
        body.alias("text"),
    )
    keys = ["doc", "t1", "t2"]
    texts = texts.withColumns({"ht": F.xxhash64("t1", "t2"), "hr": F.xxhash64(*keys)})
    known = settle(texts.select(*keys, F.octet_length("text").alias("size"))).where(F.col("size") >= length)
    first = settle(known.groupBy("t1", "t2").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")))
    later = known.join(first.where("n > 1").drop("n"), ["t1", "t2"]).where("doc > least")
    whole = later.select(*keys, F.lit(0).alias("start"), "size").distinct()
    copies = copy_filters(first.select(F.xxhash64("t1", "t2").alias("ht"), F.xxhash64("least", "t1", "t2").alias("hr"), "n"), filter_bits)
    anchors = repeated_hashes(texts, copies, length, k, filter_bits)
    sides = repeated_hashes(texts, copies, length, k, filter_bits, anchors)
    spans = settle(bucket_spans(segments(texts, copies, sides, length, k), length).unionByName(whole))
    return cut_out(texts, spans, filter_bits).select(
        F.when(F.col("doc") != LAST_ID, F.col("doc")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept"
    )
