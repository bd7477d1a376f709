"""Quality rules: base counts by definition, the model against a plain Kneser-Ney, verdicts from its scores."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from __spark_entry__ import queries
from tideshift.llm import perplexity as ppl

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text("ab \n\t#é", max_size=40), st.text(max_size=20)), max_size=6))
def test_base_counts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    made = ppl.base_counts(np.frombuffer(b"".join(raw), np.uint8), offsets, ppl._tables())
    got = list(zip(*[made[n].tolist() for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))
    assert got == [base(t) for t in texts]


def sequence(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.sub(f"[{SPACE}]+", " ", re.sub("[0-9]", "0", text))


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney, straight from the definition, for one language."""
    counts = Counter()
    for text in texts:
        s = "\n" * (order - 1) + sequence(text)
        counts.update(s[i : i + order] for i in range(len(s) - order + 1))
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def discounts(table):
        n = [sum(c == k for c in table.values()) for k in range(5)]
        if not n[1] + 2 * n[2]:
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        return [max(0, min(k, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 for k in (1, 2, 3)]

    cut = {n: discounts(t) for n, t in tables.items()}
    sums = {n: defaultdict(lambda: [0, 0.0]) for n in tables}
    for n, table in tables.items():
        for g, c in table.items():
            sums[n][g[:-1]][0] += c
            sums[n][g[:-1]][1] += cut[n][min(c, 3) - 1]

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / len(tables[1])
        if gram[:-1] not in sums[n]:
            return p(gram[1:])
        total, mass = sums[n][gram[:-1]]
        c = tables[n][gram]
        return (c - cut[n][min(c, 3) - 1] if c else 0) / total + mass / total * p(gram[1:])

    return p


TEXTS = ["the cat sat on the mat. The cat ate 27 rats", "on the mat sat the other cat\n\n and the hat", "é the the", "a"] * 2


def test_probabilities(spark):
    order = 4
    df = spark.createDataFrame([(t, "en") for t in TEXTS] + [("zz zz", "de"), (None, "en"), ("", None)], "text string, lang string")
    grams, _ = ppl.kneser_ney(ppl.count_grams(df, order), order)
    p = plain_model(TEXTS, order)
    rows = grams.where("lang = 'en'").collect()
    assert len(rows) > 100
    for r in rows:
        assert r.p == pytest.approx(p(r.gram), rel=1e-9)


def test_bits_of_seen_and_unseen_texts(spark):
    order = 4
    df = spark.createDataFrame([(t, "en") for t in TEXTS], "text string, lang string")
    model = ppl.fit(df, order)
    p = plain_model(TEXTS, order)
    tables = ppl.SortedHashes(*model.arrays[:2]), ppl.SortedHashes(*model.arrays[2:])
    for text in ["the cat ate the mat", "a hat that sat", "ttttt"]:
        codes, row = ppl.normalised([text], order)
        got = ppl.gram_bits(codes, ppl._row_keys(["en"])[row], order, *tables)
        s = "\n" * (order - 1) + sequence(text)
        want = [-math.log2(p(s[i : i + order])) for i in range(len(s) - order + 1)]
        assert got.tolist() == pytest.approx(want, abs=1e-4)


def test_both_ways_of_scoring_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(None, "x y", "en"), (3, None, None), (3, None, None), (9, "", "qq"), (8, "w " * 30_000, None)], docs.schema)
    df = docs.unionByName(odd).withColumn("kept", docs.doc_id).withColumn("digest", docs.doc_id)
    one = sorted(map(tuple, ppl.judge(df).collect()), key=str)
    other = sorted(map(tuple, ppl.judge(df, max_rows=0).collect()), key=str)
    assert len(one) == len(other) == df.count()
    for a, b in zip(one, other):
        assert a[:9] == b[:9] and a[9:] == pytest.approx(b[9:], abs=1e-4) if a[9] is not None else a == b


def test_query_counts_and_verdicts(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries()["op1_quality"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n, *rest = base(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [n, *rest]
        assert r.base_failed == (n < 50 or 100 * rest[-1] > 50 * n)
        if r.bits_per_char is not None and not r.base_failed:
            assert r.kept == (r.lower <= r.bits_per_char <= r.upper)
        else:
            assert not r.kept


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert ppl.judge(df).count() == 0
