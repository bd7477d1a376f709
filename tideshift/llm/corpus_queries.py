"""The registered queries of the text operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideshift.llm import (
    alignment, bpe, collocations, langid, licenses, mixing, perplexity, pii, repeats, rotated_codes, simhash, toxicity, urlfilter,
)
from tideshift.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and digests of the ids and of the text decoded from them."""
    vocabulary = bpe.load_vocabulary(public_tokenizers.path(TOKENIZER))
    done = bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, bits per character and verdict of every document."""
    return perplexity.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", *perplexity.STATS, "base_failed", "kept", "language", F.round("bits", 6).alias("bits_per_char"),
        F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"),
    )


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.learnable(docs))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


PII_KEY = "corpus release 1"  # in production from the secret store of the deployment


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms for personal data, and how many of each kind were replaced."""
    done = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return done.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), *pii.counts_by_kind(F.col("found")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot, block and place of every document in a mix whose weights are square roots of the sources' sizes."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
BLOCKED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; the list holds the domains that start with a blocked label."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, RULES, urlfilter.hosts_with_labels(pages, BLOCKED_LABELS))


OP2_SQL = """
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), rules(rule, domain, start, what) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fits AS (
    SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(what, length(rule)) AS what
    FROM parts JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
    GROUP BY page_id
), listed AS (
    SELECT *, regexp_matches(host, '(^|[.])(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)[.].') AS listed
    FROM parts
)
SELECT l.page_id, host, path, f.rule, listed, coalesce(f.what, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM listed l LEFT JOIN fits f ON l.page_id = f.page_id
"""


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, places and license labels of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and runs removed from every document as repeated, and a digest of what remains."""
    done = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows by inner product of every row whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return rotated_codes.nearest(rows, F.col("vec_id") % 20 == 0)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two to four words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A\x0B\x0C\x0D]')) AS piece FROM docs
), runs AS (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
    SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS place FROM runs
), followed AS (
    SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
    FROM words WINDOW o AS (PARTITION BY id ORDER BY place)
), grams AS (
    SELECT lang, 1 AS k, w1 AS p FROM followed
    UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM followed WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM followed WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM followed WHERE w4 IS NOT NULL
), f AS (
    SELECT lang, k, p, count(*) AS n FROM grams GROUP BY lang, k, p HAVING count(*) >= 30
), totals AS (
    SELECT lang, count(*) AS total FROM words GROUP BY lang
), found AS (
    SELECT lang, k, p, string_split(p, ' ') AS s, n FROM f WHERE k > 1
), halves AS (
    SELECT lang, p, n AS a, j, array_to_string(s[1:j], ' ') AS head, array_to_string(s[j + 1:k], ' ') AS tail
    FROM found, (VALUES (1), (2), (3)) js(j) WHERE j < k
), cuts AS (
    SELECT h.lang, h.p, a, j, x.n AS l, y.n AS r, (2000000::HUGEINT * a) // (x.n + y.n) AS score
    FROM halves h JOIN f x ON x.lang = h.lang AND x.p = h.head JOIN f y ON y.lang = h.lang AND y.p = h.tail
), lowest AS (
    SELECT lang, p, a, l, r, score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1
), shorter AS (
    SELECT lang, n, array_to_string(s[i:i + j - 1], ' ') AS p
    FROM found, (VALUES (2), (3)) js(j), (VALUES (1), (2), (3)) starts(i) WHERE j < k AND i + j - 1 <= k
), gone AS (
    SELECT DISTINCT s.lang, s.p FROM shorter s JOIN found c ON c.lang = s.lang AND c.p = s.p WHERE 100 * s.n >= 80 * c.n
), kept AS (
    SELECT x.lang, x.p AS phrase, a, l, r, score
    FROM lowest x ANTI JOIN gone g ON g.lang = x.lang AND g.p = x.p
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, total::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out, and how many sentences offend."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    done = toxicity.judge(docs, toxicity.fit(docs, langid.learnable(labels)))
    return done.select(
        "doc_id", langid.held_out().alias("held_out"), "score", "predicted", "n_sentences",
        F.size("offending").cast("long").alias("n_offending"),
    )


PIECE_TOKENIZER = "piece_bpe_32k.model"


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, and how common the linked pairs are in all documents."""
    made = alignment.load_tokenizers(public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECE_TOKENIZER))
    rows = alignment.align(table(spark, sf_dir, "documents"), made)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    done = alignment.count_and_score(rows.withColumn("groups_sha256", digest).drop("groups"), made)
    return done.select("doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")


QUERIES = {"op7_neighbours": op7_neighbours, "op10_repeats": op10_repeats, "op8_licenses": op8_licenses, "op2_urls": op2_urls, "op5_mixing": op5_mixing, "op3_pii": op3_pii, "op1_quality": op1_quality, "op9_langid": op9_langid, "op4_bpe": op4_bpe, "op6_simhash": op6_simhash, "op11_collocations": op11_collocations, "op12_toxicity": op12_toxicity, "op13_alignment": op13_alignment}
ORACLE: dict[str, str] = {"op2_urls": OP2_SQL, "op11_collocations": OP11_SQL}
