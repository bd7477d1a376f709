"""Near copies at a similarity: against exact Jaccard similarities of five-word shingles, and all pairs of fingerprints."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from tideshift.llm import near_copies as nc
from tideshift.llm import simhash


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} or ({" ".join(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, text, changes):
    out = list(text)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randrange(10**6)}"
    return out


def test_budget_follows_the_similarity():
    assert nc.error_budget(1.0) == 0
    assert nc.error_budget(0.9) < nc.error_budget(0.8) < nc.error_budget(0.5)


def test_sample_keys_take_the_first_of_each_order():
    rng = np.random.default_rng(3)
    salt = nc.salts(nc.SAMPLES, 42)
    some = np.unique(rng.integers(0, 1 << 64, 3 * nc.AT_ONCE // 2, dtype=np.uint64))
    whole = nc.sample_keys(some, salt)
    ranks = np.sort(nc.mix64(some[None] ^ salt[:, None]), axis=1)[:, : nc.DRAWN]
    for key, first, s in zip(whole, ranks, salt):
        for r in first:
            s = nc.mix64(np.array([s]) * np.uint64(nc.STEP) + r)[0]
        assert s == key
    assert (nc.sample_keys(some[:2], salt) == nc.sample_keys(some[:2][::-1], salt)).all()
    assert len(nc.sample_keys(some[:0], salt)) == nc.SAMPLES


def test_bits_are_those_of_the_plain_count():
    rng = np.random.default_rng(4)
    counts = np.array([0, 1, 2, 254, 255, 256, 0, 510, 511, 5000, 7, 0])
    hashes = rng.integers(0, 1 << 64, counts.sum(), dtype=np.uint64)
    assert (nc.majority_bits(counts, hashes) == simhash.fingerprint_rows(counts, hashes)).all()
    ones = np.full(counts.sum(), (1 << 64) - 1, np.uint64)
    assert (nc.majority_bits(counts, ones) == simhash.fingerprint_rows(counts, ones)).all()
    assert len(nc.majority_bits(counts[:0], hashes[:0])) == 0


def test_one_bucket_connects_like_all_pairs(spark):
    """Chains and balls of fingerprints in one bucket: groups are those of all pairs within the budget."""
    rng = random.Random(5)
    bits, budget = 64 * nc.WORDS, nc.error_budget(0.8)
    values = [rng.getrandbits(bits) for _ in range(60)]
    for centre in values[:5]:
        for _ in range(20):
            v = centre
            for b in rng.sample(range(bits), rng.randrange(1, budget + 20)):
                v ^= 1 << b
            values.append(v)
    v = values[7]
    for _ in range(15):
        for b in rng.sample(range(bits), budget):
            v ^= 1 << b
        values.append(v)
    rows = [(i, bytearray(v.to_bytes(bits // 8, "big")), [1, 1]) for i, v in enumerate(values)]
    roots = nc.classes(spark.createDataFrame(rows, "fp long, wide binary, keys array<long>"))
    got = {r.fp: r.root for r in roots.collect()}
    label = list(range(len(values)))
    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= budget:
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    pairs = list(itertools.combinations(range(len(values)), 2))
    assert [got[i] == got[j] for i, j in pairs] == [label[i] == label[j] for i, j in pairs]


@pytest.mark.parametrize("bucket_rows", [nc.BUCKET_ROWS, 12])
def test_planted_copies(spark, bucket_rows):
    """Of copies of similarity 0.8 or more one stays, texts of similarity below 0.5 all stay; full buckets change nothing."""
    rng = random.Random(11)
    rows, passage = [], words(rng, 60)
    for i in range(40):  # alone, with a passage in common
        rows.append((1000 + i, words(rng, 150) + passage + words(rng, 150), None))
    for g in range(12):
        base = words(rng, 300)
        rows.append((2000 + 100 * g, base, g))
        rows.append((2001 + 100 * g, base, g))
        for k in range(40 if g == 0 else 3):
            rows.append((2002 + 100 * g + k, edited(rng, base, rng.randrange(1, 6)), g))
    df = spark.createDataFrame([(d, " ".join(w), g) for d, w, g in rows], "doc_id long, text string, g int").repartition(4)
    kept = {r.doc_id for r in nc.keep_one(df, bucket_rows=bucket_rows).collect()}
    sets = {d: shingles(" ".join(w)) for d, w, _ in rows}
    assert all(jaccard(sets[2000 + 100 * g], sets[2002 + 100 * g]) >= 0.8 for g in range(12))
    assert kept == {1000 + i for i in range(40)} | {2000 + 100 * g for g in range(12)}


def test_against_exact_similarities(spark):
    """On the tables: nine in ten pairs of similarity 0.8 or more are joined; what has no partner above 0.5 stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    stored = nc.settle(nc.fingerprints(docs))
    root = {r.doc: r.root for r in stored.join(nc.classes(stored), "fp").select("doc", "root").collect()}
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    held = {}
    for d, s in sets.items():
        for x in s:
            held.setdefault(x, []).append(d)
    met = {p for group in held.values() for p in itertools.combinations(sorted(group), 2)}
    close = {p: jaccard(sets[p[0]], sets[p[1]]) for p in met}
    near = [p for p, j in close.items() if j >= 0.8]
    assert len(near) > 10 and sum(root[a] == root[b] for a, b in near) >= 0.9 * len(near)
    company = {d for p, j in close.items() if j > 0.5 for d in p}
    size = {}
    for r in root.values():
        size[r] = size.get(r, 0) + 1
    assert all(size[root[d]] == 1 for d in sets if d not in company and sets[d])


def test_odd_rows_and_clashing_columns(spark):
    long = " ".join(words(random.Random(2), 70_000))
    rows = [(5, None), (3, ""), (9, " \t\n"), (None, "one"), (4, "one"), (4, "one"), (8, "two words"), (None, None), (7, "two  WORDS")]
    rows += [(11, long), (10, long + " end"), (None, "alone in the world it stands"), (None, "alone in the world it stands")]
    df = spark.createDataFrame([(d, t, "x", b"y", [0]) for d, t in rows], "doc_id long, text string, fp string, wide binary, keys array<int>")
    df = df.withColumnsRenamed({"wide": "__id", "keys": "__kept_id"})
    got = nc.keep_one(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(3, ""), (4, "one"), (7, "two  WORDS"), (10, long + " end"), (None, "alone in the world it stands")], key=str
    )
    assert nc.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_rows", [6, 40, 1000])
def test_full_buckets_leave_no_pair_out(spark, bucket_rows):
    """Pairs that share one full bucket and no other are joined, as are chains that cross its pieces."""
    rng = random.Random(9)
    bits, budget = 64 * nc.WORDS, nc.error_budget(0.8)

    def near(v: int, n: int) -> int:
        for b in rng.sample(range(bits), n):
            v ^= 1 << b
        return v

    values = [rng.getrandbits(bits) for _ in range(120)]
    values += [near(v, budget) for v in values[:40]] + [near(v, budget + 1) for v in values[40:60]]
    for _ in range(30):
        values.append(near(values[-1], budget))
    rows = [(i, bytearray(v.to_bytes(bits // 8, "big")), [1, 2 + i % 2]) for i, v in enumerate(values)]
    roots = nc.classes(spark.createDataFrame(rows, "fp long, wide binary, keys array<long>"), bucket_rows=bucket_rows)
    got = {r.fp: r.root for r in roots.collect()}
    label = list(range(len(values)))
    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= budget:
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    pairs = list(itertools.combinations(range(len(values)), 2))
    assert [got[i] == got[j] for i, j in pairs] == [label[i] == label[j] for i, j in pairs]
