"""Toxicity: a plain version of features, noisy-or and gradient; held-out accuracy; planted sentences; odd rows."""

from __future__ import annotations

import re

import numpy as np
import pytest

from __spark_entry__ import queries
from tideshift.llm import toxicity
from tideshift.llm.common import utf8

SF = "/root/testdata/sf0.01"
LETTERS = toxicity.Letters().table()


def bags_of(texts, features=1 << 12):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return toxicity.split(data, np.cumsum([0, *[len(t.encode()) for t in texts]]), LETTERS, features)


def plain_sentences(text):
    """Distinct words of each sentence that has one."""
    found = []
    for part in re.findall(r"[^.!?\n。！？]*[.!?\n。！？]?", text):
        words = set(re.findall(r"[^\W\d_]+", part.lower()))
        if words:
            found.append((part, words))
    return found


TEXTS = ["You are a clown. Fine day!Next\nline", "", "12 34 ...", "no end", "éà é. É", "a a a. b", "x" * 3000 + "!" + "y z"]


def test_sentences_and_words_by_definition():
    bags = bags_of(TEXTS)
    for d, text in enumerate(TEXTS):
        plain = plain_sentences(text)
        mine = np.flatnonzero((bags.row == d) & (bags.end > 0))
        assert [text[bags.begin[i] : bags.end[i]] for i in mine] == [p for p, _ in plain]
        assert [int((bags.sentence == i).sum()) for i in mine] == [len(w) for _, w in plain]
        assert (bags.row == d).sum() == max(len(plain), 1)
    # The n-grams of "a" with its marks (one of three), and the word itself.
    one = bags_of(["a"])
    assert len(one.feature) == 2 and len(bags_of(["abcdef"]).feature) == 1 + 6 + 5 + 4 + 3
    assert sorted(bags_of(["clown"]).feature) == sorted(bags_of(["Clown? CLOWN"]).feature)


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    bags, w = bags_of(TEXTS, 64), rng.normal(0, 0.5, 64)
    toxic, weight = np.array([1, 0, 0, 1, 0, 1, 0], bool), rng.uniform(0.5, 2, 7)

    def loss(w, b):
        total = 0.0
        for d in range(7):
            logits = bags.logits(w, b)[bags.row == d]
            clean = np.prod(1 - 1 / (1 + np.exp(-logits)))
            total -= weight[d] * np.log(1 - clean if toxic[d] else clean)
        return total

    g, b, value = toxicity.gradient(bags, toxic, weight, w, -1.0)
    assert value == pytest.approx(loss(w, -1.0))
    for f in range(0, 64, 5):
        up = w.copy()
        up[f] += 1e-6
        assert g[f] == pytest.approx((loss(up, -1.0) - value) / 1e-6, abs=1e-3)
    assert b == pytest.approx((loss(w, -1 + 1e-6) - value) / 1e-6, abs=1e-3)


@pytest.fixture(scope="module")
def planted(spark):
    words = "the of and to in is that for it with as on be at by this from or an are".split()
    rng = np.random.default_rng(3)

    def sentence(bad=None):
        chosen = rng.choice(words, 6).tolist()
        if bad:
            chosen[3] = bad
        return " ".join(chosen) + "."

    docs, labels, place = [], [], {}
    for i in range(400):
        n, bad = int(rng.integers(2, 9)), i % 8 == 0
        at = int(rng.integers(0, n))
        docs.append((i, " ".join(sentence(("grobnik" if i % 16 else "grobnikar") if bad and k == at else None) for k in range(n))))
        labels.append((i, int(bad)))
        place[i] = at
    d = spark.createDataFrame(docs, "doc_id long, text string")
    return d, spark.createDataFrame(labels, "doc_id long, toxic int"), place


def test_offending_sentences_are_located(planted):
    docs, labels, place = planted
    model = toxicity.fit(docs.where("doc_id < 300"), labels)
    got = toxicity.judge(docs, model, keep=("doc_id", "text")).collect()
    for r in got:
        assert r.predicted == int(r.doc_id % 8 == 0) and r.n_sentences == r.text.count(".")
        assert [r.text[s.start : s.end].count("grobnik") for s in r.offending] == [1] * r.predicted
    assert model.losses[-1] < model.losses[0]


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries()["op12_toxicity"](spark, SF)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == 1000
    got = rows.join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()
    assert got[got.toxic == 1].predicted.mean() >= 0.7
    assert got[got.toxic == 0].predicted.mean() <= 0.02


def test_odd_rows(spark, planted):
    docs, labels, _ = planted
    odd = labels.union(spark.createDataFrame([(None, 1), (8, None), (9, 7), (0, 0), (10**9, 1)], "doc_id long, toxic int"))
    model = toxicity.fit(docs, odd, rounds=20)
    rows = [(1, None, 0.1), (2, "", 0.1), (3, "12 !?", 0.1), (None, "the grobnik is", 0.1), (5, "of to.", 0.1), (5, "of to.", 0.1),
            (6, "the of and. " * 30_000, 0.1), (7, "grobnik " * 30_000, 0.1)]
    got = toxicity.judge(spark.createDataFrame(rows, "doc_id long, text string, score double"), model, keep=("doc_id", "score")).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 8 and {by_id[i].score for i in (1, 2, 3)} == {by_id[1].score} and by_id[1].n_sentences == 0
    assert by_id[None].predicted == by_id[7].predicted == 1 and by_id[5].predicted == 0
    assert toxicity.judge(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r[:] for r in toxicity.judge(docs, toxicity.fit(docs, none)).collect()] == [(1, 0.0, 0, 1, [])]
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.judge(docs, toxicity.fit(docs, one, rounds=5)).first().predicted == 0
