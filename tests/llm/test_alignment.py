"""Alignment of two tokenizers against a definition-by-definition version over all pairs of token ranges."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tideshift.llm import alignment

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "  two  spaces ", "<|endoftext|> <s></s><unk> <0x41>", "▁under", "naïve 日本語 🙂\x00x", "ﬁ ligature", "tab\tnew\nline", "the the the", "the the the"]


@pytest.fixture(scope="module")
def made():
    return alignment.load_tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def plain(texts):
    """Token ranges by the public libraries, overlaps by comparing all of them, counts over all texts."""
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    names |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(names.values()))}
    docs, counts = [], Counter()
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        bytes_a = [bytes(names[c] for c in one.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = []
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                if max(ends_a[i] - len(bytes_a[i]), ends_b[j] - len(bytes_b[j])) < min(ends_a[i], ends_b[j]):
                    links.append((x, y))
        counts.update(links)
        shared = sorted(set(ends_a) & set(ends_b))
        groups, before = [], 0
        for end in shared:
            left = ",".join(str(x) for x, e in zip(a, ends_a) if before < e <= end)
            right = ",".join(str(y) for y, e in zip(b, ends_b) if before < e <= end)
            groups.append(f"{left}|{right}")
            before = end
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), groups)
        for n_a, n_b, n_groups, links, groups in docs
    ]


def rows_of(df, *names):
    return [tuple(r) for r in df.orderBy("doc_id").select(*names).collect()]


def test_odd_rows_by_definition(spark, made):
    texts = ODD + ["long word " + "ab" * 400]
    df = spark.createDataFrame([(i, t, 1.5) for i, t in enumerate(texts)], "doc_id long, text string, n_best double").repartition(5)
    done = alignment.count_and_score(alignment.align(df, made, keep=("doc_id",)), made)
    got = rows_of(done, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert got == plain(texts)
    assert got[1] == (0, 0, 0, 0, 0, 0, "") == got[0] and got[6][0] == 0 and got[3][0] > 0


def test_pairs_beyond_the_arrays_are_joined(spark, made):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).select("doc_id", "text")
    rows = alignment.align(docs, made)
    names = ("doc_id", "n_best", "count_sum")
    whole = rows_of(alignment.count_and_score(rows, made), *names)
    assert whole == rows_of(alignment.count_and_score(rows, made, max_pairs=50), *names)
    assert whole == rows_of(alignment.count_and_score(rows, made, max_pairs=0), *names)


def test_query_by_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500 or text is null").orderBy("doc_id")
    texts = [r.text for r in docs.limit(40).collect()]
    made = alignment.load_tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    got = rows_of(alignment.count_and_score(alignment.align(docs.limit(40), made), made), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert got == plain(texts)
    whole = queries()["op13_alignment"](spark, SF)
    assert whole.columns == ["doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256"]
    by_id = {r.doc_id: r for r in whole.collect()}
    ids = [r.doc_id for r in docs.limit(40).collect()]
    assert len(by_id) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, row in zip(ids, got):
        assert by_id[i].groups_sha256 == (hashlib.sha256(row[6].encode()).hexdigest() if row[6] else "")
        assert tuple(by_id[i])[1:5] == row[:4]


def test_empty_table_and_clashing_columns(spark, made):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.count_and_score(alignment.align(empty, made), made).count() == 0
    df = spark.createDataFrame([(None, "same text", "x"), (None, "same text", "y")], "doc_id long, text string, groups string")
    got = alignment.count_and_score(alignment.align(df, made, keep=("doc_id", "groups")), made).collect()
    assert [r.groups.count("|") for r in got] == [2, 2] and got[0].count_sum == got[1].count_sum == 2 * got[0].n_links


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(1, 60), max_size=40), st.sets(st.integers(1, 60), max_size=40), st.integers(1, 9))
def test_merge_path_of_any_piece_length(a, b, steps):
    a, b = (np.array(sorted(x | {61})) for x in (a, b))
    path = alignment.merge_path(a, b, steps)
    assert sorted(set(a.tolist()) | set(b.tolist())) == [min(x, y) for x, y in zip(a[path.i[path.links]], b[path.j[path.links]])]
    shared = sorted(set(a.tolist()) & set(b.tolist()))
    assert b[path.j[path.shared]].tolist() == shared
    assert path.group[path.from_a].tolist() == np.searchsorted(shared, a).tolist()
    assert path.group[~path.from_a].tolist() == np.searchsorted(shared, b).tolist()
    assert len(path.i) == len(a) + len(b)
