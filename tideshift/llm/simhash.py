"""SimHash near-duplicates: fingerprints of word shingles, joined by a binary trie over their bits.

Fingerprints within a few bits of each other are found by walking a binary trie against itself: pairs of nodes
go down together, differing bits add up, and a pair is left as soon as it exceeds the error budget. To deal the
walk out, each distinct fingerprint stands in one trie for each of ``budget + 1`` equal blocks of bits, rotated
to the front: two fingerprints within the budget agree on one block at least, so walks start from node pairs that
agree on a whole block. Node pairs with many fingerprints are split into pairs of their children until a task can
hold each. A walk keeps the components found so far and leaves node pairs whose fingerprints are connected
already, so a large group of near copies costs no work or output in the square of its size.

Missing texts and texts without words have fingerprint zero. Rows that repeat, and rows without an id, count as
documents of their own; a component takes the smallest id in it, which is missing only if all ids in it are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import map_texts, utf8
from tideshift.llm.components import components
from tideshift.session import settle

BITS = 64
GROUP_ROWS = 20_000  # fingerprints of a node pair that one walk takes; larger pairs are split
WALK_ROWS = 100_000
WALK_PAIRS = 1 << 16
SHINGLES_AT_ONCE = 1 << 18


def fingerprint_rows(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Majority bits of each run of hashes; ``counts`` are the lengths of the runs, an empty run gives zero."""
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    totals = np.zeros((len(filled), BITS), np.int64)
    ends = np.cumsum(counts[filled])
    for start in range(0, len(hashes), SHINGLES_AT_ONCE):
        stop = min(start + SHINGLES_AT_ONCE, len(hashes))
        bits = np.unpackbits(hashes[start:stop].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, stop, side="left"))
        cuts = np.concatenate([[0], ends[first:last] - start])
        cuts = cuts[cuts < stop - start]
        totals[first : first + len(cuts)] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    set_bits = (2 * totals > counts[filled][:, None]).astype(np.uint8)
    out[filled] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def shingle_hashes(text: bytes, width: int, seed: int) -> list[int]:
    """XXH64 of every run of ``width`` words, or of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(b" ".join(words), seed)]
    joined = b" ".join(words)
    starts = [0]
    at = 0
    for word in words:
        at += len(word) + 1
        starts.append(at)
    return [digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[width:])]


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42
) -> DataFrame:
    """``doc`` (the id), ``digest`` (of the text) and ``fp`` (the fingerprint as a signed 64-bit number) of every row."""
    schema = T.StructType([T.StructField("doc", df.schema[id_col].dataType), T.StructField("digest", T.LongType()), T.StructField("fp", T.LongType())])

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = utf8(batch.column("text"))
            raw, bounds = data.tobytes(), offsets.tolist()
            hashes, counts = [], []
            for a, b in zip(bounds, bounds[1:]):
                made = shingle_hashes(raw[a:b], width, seed)
                counts.append(len(made))
                hashes.append(np.array(made, np.uint64))
            joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            found = fingerprint_rows(np.array(counts, np.int64), joined)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("digest"), pa.array(found.view(np.int64))], names=schema.names
            )

        return step

    rows = df.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    return map_texts(rows, work, schema)


def _node_pairs(fps: DataFrame, budget: int) -> DataFrame:
    """Every fingerprint below the node pairs that agree on one whole block of bits."""
    width = BITS // (budget + 1)
    turned = F.explode(F.array(*[F.lit(i * width) for i in range(budget + 1)])).alias("rot")
    rows = fps.select("fp", turned)
    val = F.expr("shiftleft(fp, rot) | if(rot = 0, 0L, shiftrightunsigned(fp, 64 - rot))")
    return rows.select("rot", val.alias("val")).select(
        "rot",
        F.lit(width).alias("depth"),
        F.lit(0).alias("used"),
        F.shiftrightunsigned("val", BITS - width).alias("a"),
        F.shiftrightunsigned("val", BITS - width).alias("b"),
        F.lit(0).alias("side"),
        "val",
    )


PAIR = ["rot", "depth", "used", "a", "b"]


def _children(rows: DataFrame, budget: int, step: int = 8) -> DataFrame:
    """The rows below the pairs of children, ``step`` levels down, that stay within the budget."""
    masks = F.array(*[F.lit(m) for m in range(1 << step) if m.bit_count() <= budget])
    child = F.expr(f"cast(shiftrightunsigned(val, {BITS - step} - depth) & {(1 << step) - 1} as int)")
    rows = rows.withColumn("c", child).withColumn("mask", F.explode(masks))
    rows = rows.where(F.bit_count("mask") + F.col("used") <= budget).withColumn("other", F.expr("c ^ mask"))
    same = F.col("side") == 0
    mine_first = F.when(same, F.col("c") <= F.col("other")).otherwise(F.col("side") == 1)
    below = lambda node, bits: F.shiftleft(node, step).bitwiseOR(bits.cast("long"))
    return rows.select(
        "rot",
        (F.col("depth") + step).alias("depth"),
        (F.col("used") + F.bit_count("mask")).cast("int").alias("used"),
        below(F.col("a"), F.when(mine_first, F.col("c")).otherwise(F.col("other"))).alias("a"),
        below(F.col("b"), F.when(mine_first, F.col("other")).otherwise(F.col("c"))).alias("b"),
        F.when(same & (F.col("mask") == 0), 0).when(mine_first, 1).otherwise(2).alias("side"),
        "val",
    )


def _split_large(rows: DataFrame, budget: int, group_rows: int) -> DataFrame:
    """Split node pairs above ``group_rows`` into their children until none is left or no bits are."""
    done = []
    while True:
        deep = F.col("depth") <= BITS - 8
        large = rows.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > group_rows) & deep).drop("n")
        large = settle(large)
        if not large.limit(1).count():
            break
        done.append(rows.join(large, PAIR, "left_anti"))
        rows = settle(_children(rows.join(large, PAIR, "left_semi"), budget))
    for part in done:
        rows = rows.unionByName(part)
    return rows


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its component) after connecting a[i] with b[i]."""
    while True:
        left, right = label[a], label[b]
        differ = left != right
        if not differ.any():
            return label
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def walk(group: np.ndarray, side: np.ndarray, depth: np.ndarray, used: np.ndarray, val: np.ndarray, budget: int, known=None):
    """Index pairs that connect what lies within the budget inside each node pair, as spanning forests.

    All arguments have one entry per row, sorted by (group, side, val). ``val`` has one number a row, or a row of
    numbers for fingerprints of several words, the first word on top of the trie. Rows with equal numbers in ``known``
    are connected already. Returns two index arrays.
    """
    n = len(val)
    words = val.reshape(n, -1)
    bits = BITS * words.shape[1]
    label = np.arange(n)
    if known is not None:
        _, first, place = np.unique(known, return_index=True, return_inverse=True)
        label = first[place]
    before = label.copy()
    starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (side[1:] != side[:-1])]))
    ends = np.append(starts[1:], n)
    kind = side[starts]
    own = kind == 0
    # A pair of two nodes has both sides, one after the other.
    cross = np.flatnonzero((kind[:-1] == 1) & (kind[1:] == 2) & (group[starts[:-1]] == group[starts[1:]]))
    lo1 = np.concatenate([starts[own], starts[cross]])
    hi1 = np.concatenate([ends[own], ends[cross]])
    lo2 = np.concatenate([starts[own], starts[cross + 1]])
    hi2 = np.concatenate([ends[own], ends[cross + 1]])
    todo = [(lo1, hi1, lo2, hi2, depth[lo1].astype(np.int64), used[lo1].astype(np.int64))]
    breaks = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])  # counts places where neighbours are in different components
    ones = {}  # running counts of each bit, by depth
    while todo:
        lo1, hi1, lo2, hi2, at, spent = todo.pop()
        if not len(lo1):
            continue
        if len(lo1) > WALK_PAIRS:
            half = len(lo1) // 2
            todo.append((lo1[:half], hi1[:half], lo2[:half], hi2[:half], at[:half], spent[:half]))
            lo1, hi1, lo2, hi2, at, spent = (x[half:] for x in (lo1, hi1, lo2, hi2, at, spent))
            if len(lo1) > WALK_PAIRS:
                todo.append((lo1, hi1, lo2, hi2, at, spent))
                continue
        # Leave what is connected already: all of both nodes in one component.
        joined = (breaks[hi1 - 1] == breaks[lo1]) & (breaks[hi2 - 1] == breaks[lo2]) & (label[lo1] == label[lo2])
        alive = ~joined
        # Below here no pair can exceed the budget any more, so everything under both nodes is connected.
        ripe = alive & (bits - at <= budget - spent)
        if ripe.any():
            a1, b1, a2, b2 = lo1[ripe], hi1[ripe], lo2[ripe], hi2[ripe]
            left = np.concatenate([_ranges(a1, b1), _ranges(a2, b2)])
            right = np.concatenate([np.repeat(a1, b1 - a1), np.repeat(a1, b2 - a2)])
            label = _unite(label, left, right)
            breaks = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        go = alive & ~ripe
        if not go.any():
            continue
        lo1, hi1, lo2, hi2, at, spent = (x[go] for x in (lo1, hi1, lo2, hi2, at, spent))
        same = lo1 == lo2
        mid1, mid2 = np.empty_like(lo1), np.empty_like(lo2)
        for level in np.unique(at).tolist():
            if level not in ones:
                bit = (words[:, level // BITS] >> np.uint64(BITS - 1 - level % BITS)) & np.uint64(1)
                ones[level] = np.concatenate([[0], np.cumsum(bit)]).astype(np.int64)
            here, count = at == level, ones[level]
            mid1[here] = hi1[here] - (count[hi1[here]] - count[lo1[here]])
            mid2[here] = hi2[here] - (count[hi2[here]] - count[lo2[here]])
        parts = [
            (mid1, hi1, lo2, mid2, spent + 1, ~same),
            (lo1, mid1, mid2, hi2, spent + 1, None),
            (mid1, hi1, mid2, hi2, spent, None),
            (lo1, mid1, lo2, mid2, spent, None),
        ]
        made = []
        for a1, b1, a2, b2, cost, only in parts:
            keep = (a1 < b1) & (a2 < b2) & (cost <= budget)
            keep &= ~((a1 == a2) & (b1 - a1 < 2))  # one fingerprint alone
            if only is not None:
                keep &= only
            made.append(tuple(x[keep] for x in (a1, b1, a2, b2, at + 1, cost)))
        # All of one level stay together while they are few. Of more, the last half is walked first: pairs that agree
        # so far connect most and spare the others.
        todo.append(tuple(np.concatenate(x) for x in zip(*made)))
    moved = np.flatnonzero(label != before)
    return label[moved], moved


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All numbers of each range, one range after the other."""
    size = stop - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def _turn_back(val: np.ndarray, rot: np.ndarray) -> np.ndarray:
    rot = rot.astype(np.uint64)
    return np.where(rot == 0, val, (val >> rot) | (val << ((np.uint64(BITS) - rot) % np.uint64(BITS))))


def links(fps: DataFrame, budget: int = 3, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges ``a``, ``b`` that connect distinct fingerprints (column ``fp``) as all pairs within ``budget`` would."""
    if BITS % (budget + 1):
        raise ValueError("the number of blocks, budget + 1, must divide 64")
    rows = _split_large(_node_pairs(fps.select("fp").distinct(), budget), budget, group_rows)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        count = 0

        def flush(last: bool):
            whole = pa.concat_tables(held)
            read = {n: whole.column(n).to_numpy() for n in [*PAIR, "side", "val"]}
            changed = np.zeros(len(whole), bool)
            changed[0] = True
            for n in PAIR:
                changed[1:] |= read[n][1:] != read[n][:-1]
            group = np.cumsum(changed)
            cut = len(whole) if last else int(np.flatnonzero(changed)[-1])  # the last group may go on
            held[:] = [whole.slice(cut)] if cut < len(whole) else []
            if not cut:
                return None
            val = read["val"][:cut].view(np.uint64)
            order = np.lexsort((val, read["side"][:cut], group[:cut]))
            part = {n: read[n][:cut][order] for n in ("side", "depth", "used", "rot")}
            val = val[order]
            i, j = walk(group[:cut][order], part["side"], part["depth"], part["used"], val, budget)
            back = _turn_back(val, part["rot"]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(back[i]), pa.array(back[j])], names=["a", "b"])

        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
                count += batch.num_rows
            if count >= WALK_ROWS:
                made = flush(False)
                count = sum(t.num_rows for t in held)
                if made is not None:
                    yield made
        if held:
            yield flush(True)

    dealt = rows.repartition(*PAIR).sortWithinPartitions(*PAIR)
    return dealt.mapInArrow(run, schema)


def _classes(stored: DataFrame, budget: int, group_rows: int) -> DataFrame:
    """``fp`` and the ``root`` of its component, for every fingerprint."""
    distinct = settle(stored.select("fp").distinct())
    found = components(settle(links(distinct, budget, group_rows)))
    return settle(distinct.join(found, distinct["fp"] == found["vertex"], "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 3,
    budget: int = 3,
    seed: int = 42,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Every row's id (named as ``id_col``), its ``fingerprint`` (16 hex digits), ``fp`` and ``component_id``."""
    stored = settle(fingerprints(df, id_col, text, width, seed))
    roots = _classes(stored, budget, group_rows)
    least = stored.groupBy("fp").agg(F.min("doc").alias("least"))
    named = roots.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    members = settle(roots.join(named, "root").select("fp", "component_id"))
    return stored.join(members, "fp").select(
        F.col("doc").alias(id_col), hex_digits(F.col("fp")).alias("fingerprint"), "fp", "component_id"
    )


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = 3,
    budget: int = 3,
    seed: int = 42,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``df`` with one row of each component: that of the smallest id, rows without an id last.

    Of rows that share this id, one with the smallest digest of its text stays.
    """
    stored = settle(fingerprints(df, id_col, text, width, seed))
    return keep_least(df, stored, _classes(stored, budget, group_rows), id_col, text)


def keep_least(df: DataFrame, stored: DataFrame, roots: DataFrame, id_col: str, text: str) -> DataFrame:
    """``df`` with one row of each component, from ``stored`` (doc, digest, fp) and ``roots`` (fp, root)."""
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "digest")
    best = stored.groupBy("fp").agg(F.min(order).alias("best"))
    kept = roots.join(best, "fp").groupBy("root").agg(F.min("best").alias("best"))
    # Names that the caller's columns do not have, in upper or lower case.
    stem = "__kept" + "_" * max(map(len, df.columns))
    id_key, digest = f"{stem}id", f"{stem}digest"
    kept = kept.select(_id_key(F.col("best.doc")).alias(id_key), F.col("best.digest").alias(digest))
    rows = df.withColumn(id_key, _id_key(F.col(id_col))).withColumn(digest, F.xxhash64(text))
    one = rows.join(settle(kept), [id_key, digest], "left_semi").dropDuplicates([id_key, digest])
    return one.drop(id_key, digest)


def _id_key(doc: Column) -> Column:
    """An id as text, with one for missing ids, so that it can be joined on."""
    return F.coalesce(doc.cast("string"), F.lit("missing"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
