"""Language identification: held-out accuracy on the tables, and the defined results of odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from __spark_entry__ import queries
from tideshift.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    return queries()["op9_langid"](spark, SF).join(docs, "doc_id").toPandas()


def test_held_out_accuracy(predicted):
    rest = predicted[predicted.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)]
    assert (predicted.held_out.sum()) == len(rest) and rest.held_out.all()
    long = rest[rest.text.str.len() >= 40]
    assert (long.lang == long.lang_pred).mean() > 0.995
    assert predicted.score.between(0, 1).all() and len(predicted) == 1000


def test_few_documents_are_rejected(predicted):
    assert predicted.rejected.mean() < 0.01


def test_counts_by_definition():
    texts = ["Ab, c", "", "É9é"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    counts, known = langid.term_counts(np.frombuffer(data, np.uint8), offsets, langid.Letters().table(), 4096)
    # " ab", "ab ", " c " with their leading pairs; " é " twice
    assert counts.sum(axis=1).tolist() == [6, 0, 4] and known.tolist() == [True, False, True]
    assert counts[2].max() == 2


def test_odd_rows(spark):
    train = spark.createDataFrame(
        [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(50 + i, "der hund und die katze " * 3, "de") for i in range(20)]
        + [(90, None, "fr"), (91, "le chat", None), (92, "", "it")], "doc_id long, text string, lang string",
    )
    model = langid.fit(train)
    rows = [(1, None, 0.5), (2, "", 0.5), (3, "12 + 3", 0.5), (None, "the dog", 0.5), (5, "die katze", 0.5), (5, "die katze", 0.5),
            (6, "the dog " * 40_000, 0.5), (7, "日本語日本語", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = sorted(map(tuple, langid.predict(df, model).select("doc_id", "lang_pred", "rejected").collect()), key=str)
    assert got == sorted([(1, "und", True), (2, "und", True), (3, "und", True), (None, "en", False), (5, "de", False),
                          (5, "de", False), (6, "en", False), (7, got[6][1], True)], key=str)


def test_no_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit(empty)
    assert langid.predict(empty, model).count() == 0
    one = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert langid.predict(one, model).select("lang_pred", "score", "rejected").collect()[0][:] == ("und", 0.0, True)


def test_missing_id_is_neither_held_out_nor_learned(spark):
    df = spark.createDataFrame([(None, "a", "en"), (1, "b", "en")], "doc_id long, text string, lang string")
    assert df.select(langid.held_out()).collect()[0][0] is False
    assert langid.learnable(df).where("doc_id is null").count() == 0


def test_label_of_copies_keeps_its_centroid(spark):
    copies = {"x1": "bcd", "x2": "fgh", "x3": "jkl"}
    rows = [(f"{a * 3}{b} {b * 2}{a} ", name) for name, abc in copies.items() for a, b in zip(abc, abc[1:] + abc[0])]
    few = spark.createDataFrame(rows, "text string, lang string").crossJoin(spark.range(3000).select())
    ordinary = spark.range(1500).selectExpr("concat('mno pqr ', conv(id, 10, 2), ' st', id % 3) as text", "concat('o', id % 3) as lang")
    model = langid.fit(few.unionByName(ordinary))
    assert set(copies) <= set(model.languages)
    got = langid.predict(few.distinct(), model, keep=("lang",)).collect()
    assert len(got) == 9 and all(r.lang_pred == r.lang for r in got)
