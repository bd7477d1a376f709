"""License scans: base places by definition, automata against regular expressions over words."""

from __future__ import annotations

import re
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from __spark_entry__ import oracle_sql, queries
from tests.compare import difference, oracle_frame
from tideshift.llm import licenses


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def base(text):
    w = words(text)
    hits = [(i, label) for label, p in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


ODD = [
    None, "", "...", "Under THE mit-License", "under the mit license under the mit license", "xunder the mit license", "cc by nc by cc by nc",
    "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "ünder the mit license é",
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "released under the terms of the MIT License",
    "under the mit licenses", "word " * 50_000 + "under the mit license", licenses.MARK.sub("", licenses.MIT_NOTICE),
    re.sub("<<.*?>>", "", re.sub('<<var;name="what".*?>>', "this software", licenses.MIT_NOTICE, flags=re.S).replace(
        '<<var;name="holder";original="";match=".{1,20}">>', "(c) 2020 A. Person")),
    "licensed under the cc by 4.0", "GNU General Public License, version 3",
]


def test_odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "cc by nc", "x"), (1, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = {(r.doc_id, r.n_words, r.n_base): r for r in licenses.scan(df, keep=("doc_id", "labels")).collect()}
    for doc, text, _ in rows:
        n, k, first, last, labels = base(text)
        r = got[doc, n, k]
        assert (r.first_word, r.last_word, r.base_labels) == (first, last, labels)
        assert set(filter(None, labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    by = {r.doc_id: r for r in got.values()}
    assert [by[i].labels for i in (7, 8, 10, 11, 12, 13, 17, 18)] == ["cc-by-nc", "gpl-3", "apache-2", "mit", "mit", "", "cc-by", ""]
    assert by[16].labels == "mit" and by[16].spans.startswith("mit:0:")
    assert by[8].score == 1.0


def filled(template):
    return re.sub(r'<<var;.*?original="(.*?)".*?>>', r"\1", re.sub("<<(begin|end)Optional>>", "", template), flags=re.S)


def test_whole_licenses_only(spark):
    start, ads, names, end = map(filled, (licenses.BSD_START, licenses.BSD_ADVERTISING, licenses.BSD_NAMES, licenses.BSD_END))
    mit = filled(licenses.MIT_NOTICE)
    texts = [start + end, start + names + end, start + ads + names + end, start, start + names, start + end[:-20], mit, mit[:-20],
             mit[: mit.index("THE SOFTWARE IS")], mit[: mit.index("IN NO EVENT")]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(df).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["bsd-2", "bsd-3", "bsd-4", "", "", "", "mit", "", "", ""]
    assert [r.score == 1.0 for r in rows[:3]] == [True] * 3


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


TEMPLATE = 'a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d <<var;name="x";original="e";match="e|e f|g">> <<var;name="y";original="";match=".{0,2}">> h'
PATTERN = r"a (?:b (?:c )?)?d (?:e f|e|g) (?:[a-i] ){0,2}h"


def spans(pattern, text):
    """Leftmost longest matches at word starts."""
    found, at = [], 0
    for start in range(0, len(text), 2):
        ends = [e for e in range(start + 1, len(text) + 1, 2) if re.fullmatch(pattern, text[start:e])]
        if ends and start >= at:
            found.append((start // 2, (max(ends) + 1) // 2))
            at = max(ends)
    return found


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abcdefghi"), max_size=14))
def test_automaton_accepts_what_the_pattern_does(letters):
    matcher = licenses.Matcher(TEMPLATE)
    assert matcher.find([c.encode() for c in letters]) == spans(PATTERN, " ".join(letters))


def test_every_wording_of_a_template():
    matcher = licenses.Matcher(TEMPLATE)
    for opt, var, wild in product(["", "b ", "b c "], ["e", "e f", "g"], ["", "i ", "i i "]):
        assert len(matcher.find(f"a {opt}d {var} {wild}h".encode().split())) == 1
    for bad in ("a c d e h", "a b d h", "a d e i i i h", "d e h", "a d f h"):
        assert matcher.find(bad.encode().split()) == []
    for broken in ("<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>", '<<var;name="x";original="a">>'):
        with pytest.raises(ValueError):
            licenses.Matcher(broken)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    ours = queries()["op8_licenses"](spark, sf).toPandas()
    assert difference(ours, oracle_frame(oracle_sql()["op8_licenses"], sf)) is None if "op8_licenses" in oracle_sql() else True
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in ours.itertuples():
        n, k, first, last, labels = base(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, k, labels)
        assert (first is None and r.first_word != r.first_word) or (r.first_word, r.last_word) == (first, last)
    assert (ours.labels == "gpl-3").any()
