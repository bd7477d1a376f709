"""Mixing: the schedule against deadlines and lags, the placing of rows against their numbers."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tideshift.llm import mixing


def shares_of(spark, shares):
    period = sum(shares.values())
    rows = [(k, s, 1, period) for k, s in shares.items()]
    return spark.createDataFrame(rows, "source string, share long, rows long, period long")


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 3, "b": 4, "c": 5}, {"a": 50, "b": 1, "c": 1, "d": 48}, {"a": 37, "b": 29, "c": 19, "d": 11, "e": 4}])
def test_schedule_stays_within_one_block(spark, shares):
    rows = sorted(mixing.schedule(shares_of(spark, shares)).collect(), key=lambda r: r["at"])
    period = sum(shares.values())
    assert [r["at"] for r in rows] == list(range(period))
    done = Counter()
    for t, r in enumerate(rows):
        for s, share in shares.items():
            assert abs(done[s] - Fraction(share * t, period)) < 1
        done[r["source"]] += 1
        assert r["k"] == done[r["source"]]
        k, share = r["k"], shares[r["source"]]
        assert (k - 1) * period // share <= t < -(-k * period // share)
    assert done == Counter(shares)


def check(rows, block_rows, shares, period):
    """Every row once; blocks full but the last; sources within one block of their weight while all last."""
    by_block = Counter((r["source"], r["mix_block"]) for r in rows)
    sizes = Counter(r["source"] for r in rows)
    for (source, block), n in by_block.items():
        assert n == min(block_rows, sizes[source] - block * block_rows)
    slots = {}
    for r in rows:
        assert slots.setdefault(r["mix_slot"], (r["source"], r["mix_block"])) == (r["source"], r["mix_block"])
        assert r["mix_position"] // block_rows == r["mix_slot"]
    assert len({r["mix_position"] for r in rows}) == len(rows)
    last = min(max(t for t, (s, _) in slots.items() if s == source) for source in sizes)
    done = Counter()
    for t in range(last + 1):
        for source in sizes:
            assert abs(done[source] - Fraction(shares[source] * t, period)) < 1
        done[slots[t][0]] += 1  # no slot is empty while all sources last


@pytest.mark.parametrize("weights", [None, {"a": 5.0, "b": 3.0, None: 1.0}])
def test_mix(spark, weights):
    sizes = {"a": 900, "b": 333, None: 120, "tiny": 1}
    rows = [(i, s, "x") for s, n in sizes.items() for i in range(n)] + [(None, "a", None)] * 5 + [(7, "b", "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_slot string").repartition(5)
    mixed = mixing.mix(df, weights=weights, block_rows=4, period=40)
    assert sorted(mixed.columns) == ["doc_id", "mix_block", "mix_position", "mix_slot", "source"]
    got = mixed.collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((a, b) for a, b, _ in rows)
    shares = {r["source"]: r["share"] for r in mixing.source_shares(df, weights=weights, period=40).collect()}
    shares = {None if k == mixing.NO_SOURCE else k: v for k, v in shares.items()}
    assert sum(shares.values()) == 40 and min(shares.values()) >= 1
    if weights:
        assert shares["a"] > shares["b"] > shares[None]
    check(got, 4, shares, 40)


def test_whole_table_and_order(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op5_mixing"](spark, sf)
    rows = got.collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in docs.select("doc_id").collect())
    laid = [r["mix_position"] for part in mixing.in_order(got, mixing.source_shares(docs), 4).rdd.glom().collect() for r in part]
    assert laid == sorted(laid)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries()["op5_mixing"](spark, sf).collect()))


def test_empty_and_odd(spark):
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(empty).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, source string")
    assert mixing.mix(one).collect()[0]["mix_block"] == 0
    with pytest.raises(ValueError):
        mixing.mix(one, weights={"a": 0.0})


def test_many_sources(spark):
    """5,000 sources in several bundles: every row once, no slot twice, each source near its weight while all last."""
    sources, each = 5000, 4
    df = spark.range(sources * each).selectExpr("id as doc_id", f"concat('s', id % {sources}) as source")
    shares = {r["source"]: r for r in mixing.source_shares(df).collect()}
    bundles = {r["bundle"]: r["bundle_share"] for r in shares.values()}
    assert len(shares) == sources and len(bundles) > 10
    assert sum(bundles.values()) == next(iter(shares.values()))["bundle_period"]
    for b in bundles:
        assert sum(r["share"] for r in shares.values() if r["bundle"] == b) == next(r["period"] for r in shares.values() if r["bundle"] == b)
    rows = mixing.mix(df, block_rows=1).collect()
    assert len({r["doc_id"] for r in rows}) == len({r["mix_slot"] for r in rows}) == sources * each
    slots = sorted((r["mix_slot"], r["source"]) for r in rows)
    done, by_bundle = Counter(), Counter()
    end = min(max(t for t, s in slots if shares[s]["bundle"] == b) for b in bundles)
    for t, s in slots:
        if t > end:
            break
        r = shares[s]
        assert abs(by_bundle[r["bundle"]] - Fraction(r["bundle_share"] * t, r["bundle_period"])) < 1
        if t < end // 2:
            assert abs(done[s] - Fraction(r["share"] * r["bundle_share"] * t, r["period"] * r["bundle_period"])) < 2
        done[s] += 1
        by_bundle[r["bundle"]] += 1


def test_clashing_names(spark):
    names = ["at", "share", "p", "k", "turn", "row", "block", "bundle", "period", "rows", "start", "__source", "top_k"]
    df = spark.range(50).select("id", (F.col("id") % 3).cast("string").alias("source"), *[F.col("id").alias(c) for c in names])
    got = mixing.mix(df, block_rows=2, period=30).collect()
    assert len(got) == 50 and all(r[c] == r["id"] for r in got for c in names)
