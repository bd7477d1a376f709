"""Phrase collocations against a plain version with dictionaries, and the query against its SQL."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.compare import difference, oracle_frame
from tideshift.llm import collocations

SF = "/root/testdata/sf0.01"


def plain(rows, least, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            w = re.findall("[^ \t]+", piece)
            for n in range(1, 5):
                f["und" if lang is None else lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        total = sum(n for p, n in counts.items() if len(p) == 1)
        found = {p: n for p, n in counts.items() if len(p) > 1 and n >= least}
        gone = {
            p[i : i + k] for p, n in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * n >= 80 * counts[p[i : i + k]]
        }
        kept = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for place, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, place, phrase.decode(), -a, l, r, total, -score))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_matches_sql(spark):
    ours = queries()["op11_collocations"](spark, SF)
    assert ours.columns == NAMES
    assert difference(ours.toPandas(), oracle_frame(oracle_sql()["op11_collocations"], SF)) is None


def test_real_texts_by_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    got = rows_of(collocations.collocations(docs.repartition(7), least=4, top=300))
    assert got == plain(rows, 4, 300) and len(got) > 300


ODD = (
    [(None, "en"), ("", "en"), (" \t ", None), (".,;:!?\n\r", "en"), ("Ünder THE the x the x", None), ("a b", "und"), ("a b", None)]
    + [("New York city, new york City. NEW\tYORK   state", "en")] * 3
    + [("x y z w v " * 3000, "xx"), ("x y", "xx"), ("lone", "yy"), ("a b c d", "zz"), ("b c", "zz")]
)


@pytest.mark.parametrize(("max_words", "pair_bits"), [(10**6, 30), (0, 16)])
def test_odd_rows_by_definition(spark, max_words, pair_bits):
    df = spark.createDataFrame([(t, lang, 1) for t, lang in ODD], "text string, lang string, score int").repartition(5)
    got = rows_of(collocations.collocations(df, least=2, top=5, max_words=max_words, pair_bits=pair_bits))
    assert got == plain(ODD, 2, 5)
    assert {r[0] for r in got} == {"und", "en", "xx", "zz"}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("a b", "en")], "text string, lang string")).count() == 0


def test_one_pair_starts_everything(spark):
    words = spark.range(3000).select(F.concat(F.lit("of the w"), (F.col("id") % 700).cast("string"), F.lit(" of the")).alias("text"), F.lit("en").alias("lang"))
    rows = [tuple(r) for r in words.collect()]
    assert rows_of(collocations.collocations(words, least=4, top=900)) == plain(rows, 4, 900)


def test_full_table_of_pairs_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations.PairBits, "has", lambda self, digests: digests == digests)
    rows = [("a b c a b d " * 3, "en"), ("a b c", "en"), ("b d", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert rows_of(collocations.collocations(df, least=2, top=50)) == plain(rows, 2, 50)


def test_counts_beyond_64_bits():
    import numpy as np

    many = np.array([3 * 10**18, 5], np.int64)
    assert collocations.exact(many, 2_000_000).tolist() == [6 * 10**24, 10**7]
    assert collocations.exact(many[1:], 80).dtype == np.int64
