"""From raw documents to tokens: five stages, each writing the table that the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideshift.llm import bpe, langid, mixing, near_copies, pii
from tideshift.llm.common import table
from tideshift.llm.corpus_queries import PII_KEY, TOKENIZER
from tideshift.session import settle, shuffle_partitions

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those that no centroid is near to go."""
    docs = docs.select(*COLUMNS)
    model = langid.fit(langid.learnable(docs))
    return langid.predict(docs, model, keep=COLUMNS).where(~F.col("rejected")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    Missing and empty texts are one group. Of rows that share the smallest id, one with the smallest digest stays; rows without
    an id come last.
    """
    return near_copies.keep_one(docs.select(*COLUMNS), width=5, similarity=0.8).select(*COLUMNS)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data; their lengths are taken anew."""
    done = pii.pseudonymise(docs.select(*COLUMNS), PII_KEY, found="__found")
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents in the order of the mix: file after file, sources interleave at their weights."""
    docs = docs.select(*COLUMNS)
    placed = mixing.mix(docs)
    return mixing.in_order(placed, mixing.source_shares(docs), shuffle_partitions(spark)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with its place in the mix, and digests of the ids and of the text decoded from them.

    A table has no order of its own once its files are read in pieces, so the place is a column: ``mix`` gives the
    rows that it gave before the same slots and positions again. Missing texts have no tokens.
    """
    vocabulary = bpe.load_vocabulary(public_tokenizers.path(TOKENIZER))
    keep = ("doc_id", "source", "mix_slot", "mix_position")
    done = bpe.round_trip(mixing.mix(docs.select(*COLUMNS)).select(*keep, "text"), vocabulary, keep=keep)
    return done.select(
        *keep,
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", known_languages),
    ("near_duplicates", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("mixing", mixed),
    ("tokens", tokens),
]
ORACLE_SQL = None  # centroids, fingerprint components and token merges are beyond SQL; tests/llm compares each stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
