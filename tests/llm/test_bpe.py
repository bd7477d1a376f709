"""BPE against the tokenizers library: ids and decoded texts must be equal."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideshift.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n \t x", "a" * 5000, "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "don't WE'LL it's",
    "\x1c\x1d\x85 　  x", "é 日本語 ١٢٣ ½ 𝔘🙂", "\x00\x01", "ab " * 3000, "<|endoftext|", "﻿a​b",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_odd_texts(spark, vocabulary, library):
    rows = [(i, t, i) for i, t in enumerate(ODD)] + [(None, "same", 0), (7, "same", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.round_trip(df, vocabulary).collect()
    assert len(got) == len(rows)
    by_text = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or ""))
    for row, made in zip(by_text, sorted(got, key=lambda r: (r[0] is None, r[0], r.decoded))):
        ids, text = expected(library, row[1])
        assert np.frombuffer(made.token_ids, "<u4").tolist() == ids
        assert made.n_tokens == len(ids) and made.decoded == text


def test_documents(spark, vocabulary, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = bpe.decode_tokens(bpe.encode_texts(docs, vocabulary, keep=("doc_id", "text")), vocabulary,
                             keep=("text", "token_ids")).collect()
    assert len(made) == docs.count()
    for row in made:
        assert np.frombuffer(row.token_ids, "<u4").tolist() == expected(library, row.text)[0]
        assert row.decoded == row.text


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(df, vocabulary).count() == 0


@pytest.fixture(scope="module")
def pieces(vocabulary):
    return bpe.Pieces(vocabulary, bpe.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab tsheni'\n", max_size=60), st.text("thentionredaw", max_size=80)))
def test_any_text(pieces, library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(pieces.encode([text])[0], "<u4").tolist() == expected(library, text)[0]


def test_sources_of_nulls(spark, vocabulary):
    df = spark.createDataFrame([(1, None)], "doc_id long, token_ids binary")
    assert bpe.decode_tokens(df, vocabulary).select(F.col("decoded")).collect()[0][0] == ""
