"""Nearest neighbours against brute force: exact scores and order, and recall."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tideshift.llm import rotated_codes as codes

INF = float("inf")


def brute(ids, vectors, asks, k):
    out = {}
    for i in np.flatnonzero(asks):
        score = np.einsum("j,ij->i", vectors[i], vectors)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def compare(got, want, k, recall=0.9):
    found = {}
    for r in sorted(got, key=lambda r: (r[0], r[1])):
        found.setdefault(r[0], []).append((r[2], r[3]))
        assert r[1] == len(found[r[0]])
    assert set(found) == {q for q, best in want.items() if best}
    hits = total = 0
    for q, best in want.items():
        exact = dict(best)
        assert len(found.get(q, [])) == len(best)
        assert found.get(q, []) == sorted(found.get(q, []), key=lambda x: (-x[1], x[0]))
        hits += len(exact.keys() & dict(found.get(q, [])).keys())
        total += len(best)
        for i, s in found.get(q, []):
            if i in exact:
                assert s == pytest.approx(exact[i], abs=1e-12)
    assert total == 0 or hits / total >= recall


@pytest.mark.parametrize("shape", ["even", "clusters", "copies", "lengths"])
def test_recall(spark, shape):
    rng = np.random.default_rng(3)
    n, d = 3000, 24
    v = rng.standard_normal((n, d))
    if shape == "clusters":
        v = rng.standard_normal((20, d))[rng.integers(0, 20, n)] + 0.05 * v
    if shape == "copies":
        v[: n // 3] = v[0]
    if shape == "lengths":
        v *= rng.exponential(2, n)[:, None]
    v = v.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<float>").repartition(3)
    got = codes.nearest(df, F.col("vec_id") % 20 == 0, block_vectors=400, block_queries=60).collect()
    compare(got, brute(np.arange(n), v, np.arange(n) % 20 == 0, 20), 20, 0.98)


def test_odd_rows(spark):
    good = [(0, [1.0, 0.0, 2.0]), (20, [0.0, 1.0, 0.5]), (1, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0]), (-20, [-3.0, 0.0, 0.0])]
    bad = [(40, None), (3, [0.0, 0.0, 0.0]), (60, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [INF, 1.0, 1.0]), (80, [1.0, 2.0]),
           (None, [1.0, 1.0, 1.0]), (6, [])]
    df = spark.createDataFrame([(i, v, 9) for i, v in good + bad], "vec_id long, embedding array<double>, rank int")
    got = codes.nearest(df, F.col("vec_id") % 20 == 0).collect()
    ids = np.array([i for i, _ in good])
    compare(got, brute(ids, np.array([v for _, v in good]), ids % 20 == 0, 20), 20, 1.0)


def test_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0])] * 3 + [(1, [1.0, 1.0])] * 2, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, codes.nearest(df, F.col("vec_id") % 20 == 0).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 1, 1.0)]
    assert codes.nearest(df.limit(0), F.lit(True)).count() == 0
    assert codes.nearest(df, F.lit(False)).columns == ["query_id", "rank", "vec_id", "score"]


def test_estimates_are_close_and_bounded():
    rng = np.random.default_rng(8)
    v, q = rng.standard_normal((4000, 64)) * 3, rng.standard_normal((50, 64))
    turn = codes.rotation(64)
    guess, error = codes.estimates(*codes.encode(v, turn), q, turn)
    off = (guess - q @ v.T) / error
    assert abs(off.mean()) < 0.05 and 0.8 < off.std() < 1.1
    assert (np.abs(off) > codes.ERROR_FACTOR).mean() < 0.002


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(np.float64)
    got = queries()["op7_neighbours"](spark, sf).collect()
    compare([(r.query_id, r.rank, r.vec_id, r.score) for r in got], brute(ids, v, ids % 20 == 0, 20), 20, 0.99)
