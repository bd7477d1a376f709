"""Near copies at a given similarity: long SimHash fingerprints, walked as binary tries inside buckets of samples.

At a Jaccard similarity of 0.8 about 15 of 100 SimHash bits differ. A trie over all fingerprints with such a
budget visits nearly all pairs, so documents are dealt out first: each has ``SAMPLES`` keys, and a key is made of
the ``DRAWN`` shingles that come first in one random order. Two documents of similarity s share a key with
probability s ** DRAWN, and one of all keys with 1 - (1 - s ** DRAWN) ** SAMPLES (0.998 at 0.8). Inside a bucket
of one key the trie of ``simhash.walk`` runs over fingerprints of 512 bits, whose error budget follows from the
similarity: the bits that differ on average there, and ``MARGIN`` standard deviations more.

A bucket may grow without bound where many documents share a passage. Buckets above ``bucket_rows`` distinct
fingerprints are cut into pieces of about half as many. Each piece is walked by itself first; then every two pieces
of a bucket are walked against each other, except where all are connected by then, and what is connected is not
compared again. So no pair of a bucket is left out, and no task holds more than two pieces of a bucket; where a full
bucket's members are all unlike, its work grows with the square of its size, spread over the pairs of pieces.

Copies share a fingerprint and cost one row in each bucket. Missing texts and texts without words have fingerprint
zero and are one group; texts of fewer words than a shingle are compared whole. Rows that repeat and rows without
an id count as documents of their own. Columns of any name may stand in the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm import simhash
from tideshift.llm.common import map_texts, mix64, utf8
from tideshift.llm.components import components
from tideshift.session import settle

WORDS = 8  # 64-bit words of a fingerprint
SAMPLES = 12
DRAWN = 4
MARGIN = 1.65
BUCKET_ROWS = 20_000
WALK_ROWS = 50_000
AT_ONCE = 1 << 16
STEP = 0x9E3779B97F4A7C15
LANES = np.uint64(0x0101010101010101)
LANE_ROWS = 255  # hashes whose bits a lane of eight bits can count


def error_budget(similarity: float, bits: int = WORDS * simhash.BITS, margin: float = MARGIN) -> int:
    """Bits that may differ: those of two equally long shingle sets of this Jaccard similarity, with the margin."""
    share = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    return int(bits * share + margin * math.sqrt(bits * share * (1 - share)))


def salts(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(STEP) + np.uint64(seed))


def sample_keys(shingles: np.ndarray, salt: np.ndarray, drawn: int = DRAWN) -> np.ndarray:
    """One key for each salt, from the ``drawn`` distinct shingles that come first in the order of that salt."""
    low = np.zeros((len(salt), 0), np.uint64)
    for start in range(0, len(shingles), AT_ONCE):
        ranks = mix64(shingles[None, start : start + AT_ONCE] ^ salt[:, None])
        low = np.concatenate([low, ranks], axis=1)
        if low.shape[1] > drawn:
            low = np.partition(low, drawn - 1, axis=1)[:, :drawn]
    low = np.sort(low, axis=1)
    key = salt.copy()
    for column in low.T:
        key = mix64(key * np.uint64(STEP) + column)
    return key


def majority_bits(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """As ``simhash.fingerprint_rows``, with every eighth bit counted at once in the bytes of one number."""
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    size = counts[filled]
    pieces = -(-size // LANE_ROWS)
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    starts = np.repeat(np.cumsum(size) - size, pieces) + within * LANE_ROWS
    lanes = np.empty((len(starts), 8, 8), np.uint8)
    for j in range(8):
        lanes[:, :, j] = np.add.reduceat((hashes >> np.uint64(j)) & LANES, starts).astype("<u8").view(np.uint8).reshape(-1, 8)
    totals = np.add.reduceat(lanes.reshape(-1, simhash.BITS), first, axis=0, dtype=np.int64)
    set_bits = (2 * totals > size[:, None]).astype(np.uint8)
    out[filled] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, seed: int = 42) -> DataFrame:
    """``doc``, ``digest`` of the text, ``fp`` (a hash of the fingerprint), ``wide`` (its bits) and ``keys`` of every row."""
    fields = [("doc", df.schema[id_col].dataType), ("digest", T.LongType()), ("wide", T.BinaryType()), ("keys", T.ArrayType(T.LongType()))]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def work():
        salt, shift = salts(SAMPLES, seed), salts(WORDS, seed + 1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = utf8(batch.column("text"))
            raw, bounds = data.tobytes(), offsets.tolist()
            sets, keys = [], []
            for a, b in zip(bounds, bounds[1:]):
                sets.append(np.unique(np.array(simhash.shingle_hashes(raw[a:b], width, seed), np.uint64)))
                keys.append(sample_keys(sets[-1], salt))
            counts = np.array([len(x) for x in sets], np.int64)
            joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            wide = np.stack([majority_bits(counts, mix64(joined ^ s)) for s in shift], axis=1).astype(">u8")
            flat = pa.array(np.concatenate(keys).view(np.int64)) if keys else pa.array([], pa.int64())
            made = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * SAMPLES), flat)
            bits = pa.array([row.tobytes() for row in wide], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("digest"), bits, made], names=schema.names)

        return step

    rows = df.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    return map_texts(rows, work, schema).withColumn("fp", F.xxhash64("wide"))


def _buckets(stored: DataFrame) -> DataFrame:
    """``key``, ``fp``, ``wide``: every distinct fingerprint in its buckets."""
    rows = settle(stored.groupBy("fp").agg(F.first("wide").alias("wide"), F.first("keys").alias("keys")))
    return settle(rows.select(F.explode(F.array_distinct("keys")).alias("key"), "fp", "wide"))


def _full(rows: DataFrame, bucket_rows: int) -> DataFrame:
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)


def links(stored: DataFrame, similarity: float = 0.8, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``a``, ``b`` between values of ``fp`` that connect what lies within the error budget in one bucket."""
    budget = error_budget(similarity)
    rows = _buckets(stored)
    full = settle(_full(rows, bucket_rows))
    if not full.limit(1).count():
        return _walked(rows, budget)
    pieces = F.ceil(2 * F.col("n") / bucket_rows).cast("int")
    piece = F.pmod(F.xxhash64("key", "fp"), pieces).cast("int")
    crowd = settle(rows.join(full, "key").select("key", "fp", "wide", pieces.alias("pieces"), piece.alias("piece")))
    rest = rows.join(full.select("key"), "key", "left_anti")
    alone = crowd.select(F.xxhash64("key", "piece").alias("key"), "fp", "wide")
    found = settle(_walked(rest.unionByName(alone), budget))
    crossed = settle(_walked(_two_pieces(crowd, components(found)), budget))
    return found.unionByName(crossed)


def _two_pieces(crowd: DataFrame, found: DataFrame) -> DataFrame:
    """Every two pieces of each full bucket under a key of their own, one as side 1 and one as side 2, with the ``root``
    that each fingerprint has so far. Buckets whose members are all connected are left out."""
    named = crowd.join(found, crowd["fp"] == found["vertex"], "left").select(*crowd.columns, F.coalesce("root", "fp").alias("root"))
    named = settle(named)
    open_ones = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    others = named.join(open_ones.select("key"), "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    others = others.where("other <> piece")
    return others.select(
        F.xxhash64("key", F.least("piece", "other"), F.greatest("piece", "other")).alias("key"), "fp", "wide",
        F.when(F.col("piece") < F.col("other"), 1).otherwise(2).alias("side"), "root",
    )


def _walked(rows: DataFrame, budget: int) -> DataFrame:
    """Edges inside each ``key`` of ``rows``, or between its two sides."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    sided = "side" in rows.columns

    def flush(held: list[pa.Table], last: bool) -> pa.RecordBatch | None:
        whole = pa.concat_tables(held).combine_chunks()
        key = whole.column("key").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        cut = len(key) if last else int(starts[-1])  # the last bucket may go on
        held[:] = [whole.slice(cut)] if cut < len(key) else []
        starts = starts[starts < cut]
        size = np.diff(np.append(starts, cut))
        group = np.repeat(np.arange(len(starts)), size)
        rows = np.flatnonzero(np.repeat(size > 1, size))
        if not len(rows):
            return None
        fp, group = whole.column("fp").to_numpy()[rows], group[rows]
        bits = b"".join(whole.column("wide").take(pa.array(rows)).to_pylist())
        val = np.frombuffer(bits, ">u8").astype(np.uint64).reshape(len(rows), WORDS)
        none = np.zeros(len(rows), np.int64)
        side = whole.column("side").to_numpy()[rows] if sided else none
        known = whole.column("root").to_numpy()[rows] if sided else fp
        order = np.lexsort((*val.T[::-1], side, group))
        i, j = simhash.walk(group[order], side[order], none, none, val[order], budget, known[order])
        return pa.RecordBatch.from_arrays([pa.array(fp[order[i]]), pa.array(fp[order[j]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            count += batch.num_rows
            if count >= WALK_ROWS:
                made = flush(held, False)
                count = sum(t.num_rows for t in held)
                if made is not None:
                    yield made
        if held and (made := flush(held, True)) is not None:
            yield made

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def classes(stored: DataFrame, similarity: float = 0.8, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``fp`` and the ``root`` of its group, for every fingerprint of ``stored``."""
    found = components(settle(links(stored, similarity, bucket_rows)))
    distinct = stored.select("fp").distinct()
    return settle(distinct.join(found, distinct["fp"] == found["vertex"], "left").select("fp", F.coalesce("root", "fp").alias("root")))


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 5,
    similarity: float = 0.8,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``df`` with one row of each group of near copies: that of the smallest id, rows without an id last.

    Of rows that share this id, one with the smallest digest of its text stays.
    """
    stored = settle(fingerprints(df, id_col, text, width, seed))
    return simhash.keep_least(df, stored, classes(stored, similarity, bucket_rows), id_col, text)
