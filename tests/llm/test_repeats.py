"""Repeated passages against the definition, string by string."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from __spark_entry__ import queries
from tideshift.llm import repeats

LAST = float("inf")


def expected(rows, length):
    """For each (id, text): number of bytes, removed bytes, runs and the rest."""
    least = {}
    raw = [((LAST if d is None else d), (t or "").encode()) for d, t in rows]
    for d, b in raw:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            least[s] = min(least.get(s, LAST), d)
    out = []
    for d, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < d:
                gone[i : i + length] = True
        gone = gone[:-1]
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        out.append((None if d == LAST else int(d), len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, start int, n_bytes string")
    made = repeats.remove_repeats(df.repartition(4), **options)
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in made.collect()), key=str)


def corpus(seed, n=60, words=40):
    """Texts from few words, with passages, copies and near copies shared among them."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdé ", k=rng.randint(1, 9))) for _ in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 30))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 15))) for _ in range(rng.randint(0, 5))]
        texts.append(" ".join(parts))
    texts += texts[:5] + [t[:30] + "#" + t[30:] for t in texts[:10]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("filter_bits", [27, 15])
def test_texts_of_few_words(spark, seed, filter_bits):
    rows = list(enumerate(corpus(seed)))
    random.Random(seed).shuffle(rows)
    rows += [(None, rows[0][1]), (None, None), (3, rows[7][1]), (500, ""), (501, None)]
    rows += [rows[2], rows[2], (1000, "ab" * 4000), (2000, "ab" * 3000), (1500, "b" * 49), (1501, "b" * 50), (1502, "b" * 51)]
    assert run(spark, rows, filter_bits=filter_bits) == expected(rows, 50)


@pytest.mark.parametrize("length,k", [(8, 3), (12, 12)])
def test_short_strings(spark, length, k):
    rows = list(enumerate(corpus(5, 40, 12)))
    assert run(spark, rows, length=length, k=k) == expected(rows, length)


def test_small_buckets_and_memories(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_ROWS", 40)
    monkeypatch.setattr(repeats, "KNOWN_SEGMENTS", 5)
    monkeypatch.setattr(repeats, "HELD_ANCHORS", 50)
    rows = list(enumerate(corpus(9)))
    assert run(spark, rows) == expected(rows, 50)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(df).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.text("ab", min_size=4, max_size=14)), min_size=1, max_size=8))
def test_intervals_of_segments(segments):
    """The spans of a bucket against all strings of four bytes."""
    raw = [t.encode() for _, t in segments]
    docs = np.array([d for d, _ in segments])
    data = np.frombuffer(b"".join(raw), np.uint8)
    bounds = np.cumsum([0, *map(len, raw)])
    got = [np.zeros(len(b), bool) for b in raw]
    for s, a, n in zip(*repeats.repeats_of(data, bounds, docs, 4)):
        got[s][a : a + n] = True
    least = {}
    for d, b in zip(docs, raw):
        for i in range(len(b) - 3):
            least[b[i : i + 4]] = min(least.get(b[i : i + 4], 9), d)
    for d, b, made in zip(docs, raw, got):
        want = np.zeros(len(b), bool)
        for i in range(len(b) - 3):
            if least[b[i : i + 4]] < d:
                want[i : i + 4] = True
        assert made.tolist() == want.tolist()


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(d, n, g, s, hashlib.sha256(k).hexdigest()) for d, n, g, s, k in expected(rows, 50)]
    assert sorted(map(tuple, queries()["op10_repeats"](spark, sf).collect()), key=str) == sorted(want, key=str)
