"""SimHash: fingerprints by definition, components by comparing all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from __spark_entry__ import queries
from tideshift.llm import simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, budget=3):
    """The smallest index reachable from each one."""
    values = np.array(values, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    label = classes(fps)
    members = {}
    for (doc, _), c in zip(rows, label):
        members.setdefault(c, []).append(doc)
    least = {c: min((d for d in m if d is not None), default=None) for c, m in members.items()}
    return sorted(((doc, f"{f:016x}", least[c]) for (doc, _), f, c in zip(rows, fps, label)), key=str)


def test_odd_rows(spark):
    base = "The quick brown fox jumps over the lazy dog and runs far away from here every single day " * 8
    rows = [(5, None), (3, ""), (9, " \t\n"), (None, "one"), (4, "one"), (4, "one"), (8, "two words"), (None, None)]
    rows += [(20 + i, base + f" tail{i}") for i in range(30)] + [(60, base.upper()), (61, "ÄÖ ß x " * 5000)]
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries()["op6_simhash"](spark, sf).collect()), key=str) == expected(rows)


def planted(rng):
    """Random numbers, chains and balls of neighbours, and all-equal blocks."""
    values = [int(v) for v in rng.integers(0, 1 << 64, 300, dtype=np.uint64)]
    for centre in values[:6]:
        for _ in range(60):
            v = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                v ^= 1 << int(b)
            values.append(v)
    v = values[7]
    for _ in range(40):  # a chain
        for b in rng.choice(64, 3, replace=False):
            v ^= 1 << int(b)
        values.append(v)
    values += [i for i in range(64)] + [0, (1 << 64) - 1]
    return sorted(set(values))


@pytest.mark.parametrize("group_rows", [20_000, 16])
def test_links_connect_like_all_pairs(spark, group_rows):
    values = planted(np.random.default_rng(1))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(df, group_rows=group_rows).collect()]
    assert all((a ^ b).bit_count() for a, b in edges)
    where = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in edges:
        i, j = root(where[a]), root(where[b])
        label[max(i, j)] = min(i, j)
    assert [root(i) for i in range(len(values))] == classes(values)
    if group_rows > len(values):  # four forests, not all pairs
        assert len(edges) < 4 * len(values)


def test_one_row_of_each_component_stays(spark):
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 20
    rows = [(i, base + f"tail{i}", "x") for i in range(10, 20)] + [(3, "other", "x"), (3, "other", "x"), (4, "other", "y"), (3, base + "tail12", "z")]
    rows += [(None, "alone", None), (None, "alone", None), (None, "other", None), (8, None, None), (9, "", None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, kind string, fp int").repartition(3)
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    label = classes([fingerprint(t) for _, t, _ in rows])
    want = {}
    for row, c in zip(rows, label):
        want.setdefault(c, []).append((row[0] is None, row[0] or 0))
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect())
    assert kept == sorted(min(m) for m in want.values())
    assert simhash.keep_one(df.limit(0)).count() == 0
