"""Language identification by nearest centroid over TF-IDF character n-grams.

Letters are lower-cased, everything else becomes a space, and the runs of two and three characters are hashed
into a fixed number of features. Document frequencies are counted over all labelled rows. The centroids come from
a bounded sample: at most ``SAMPLE_PER_LANGUAGE`` distinct texts for each label on average, drawn evenly over the
labels by a digest of the text, so that copies take no part in the draw. Every language gets several centroids (k-means by cosine), a document gets the language of
the nearest one, and it is rejected if its cosine lies far below what that language's sample shows.

Texts that are missing or hold no letter get ``und``, score 0, and are rejected; so does every text if there is
no labelled row. Rows that repeat are scored each for itself. Labels count as they are, a missing one teaches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import char_offsets, codepoints, map_texts, utf8, with_fields

FEATURES = 4096
CLUSTERS = 3
ROUNDS = 12
SAMPLE_PER_LANGUAGE = 250
MAX_LANGUAGES = 1000
REJECT_BELOW = 0.2  # share of the sample's lowest percentile of cosines
ROWS_AT_ONCE = 512
UNDETERMINED = "und"


@dataclass(frozen=True)
class Letters:
    """Which code points are letters (as bits), and the lower-case form of those that have one of one letter."""

    bits: np.ndarray = field(default_factory=lambda: np.packbits([chr(i).isalpha() for i in range(0x110000)]))
    upper: np.ndarray = field(
        default_factory=lambda: np.array([i for i in range(0x110000) if len(chr(i).lower()) == 1 and ord(chr(i).lower()) != i])
    )

    def table(self) -> np.ndarray:
        """Lower-case letter for each code point, or a space."""
        codes = np.arange(0x110000, dtype=np.uint32)
        codes[self.upper] = [ord(chr(i).lower()) for i in self.upper.tolist()]
        return np.where(np.unpackbits(self.bits).astype(bool), codes, np.uint32(32))


def term_counts(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts of each text (rows by features), and which texts hold a letter."""
    rows = len(offsets) - 1
    codes = letters[codepoints(data)].astype(np.uint64)
    bounds = char_offsets(data, offsets)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    letter = codes != 32
    known = np.bincount(row[letter], minlength=rows) > 0
    # A space on either side of a text, so that words at its ends have borders too.
    before = np.concatenate([[np.uint64(32)], codes[:-1]])
    after = np.concatenate([codes[1:], [np.uint64(32)]])
    filled = np.flatnonzero(np.diff(bounds))
    before[bounds[:-1][filled]] = 32
    after[bounds[1:][filled] - 1] = 32
    shift = np.uint64(64 - int(features).bit_length() + 1)
    row, before, codes, after = (x[letter] for x in (row, before, codes, after))
    base, spread = np.uint64(0x110000), np.uint64(0x9E3779B97F4A7C15)
    pairs = ((before * base + codes) * spread) >> shift
    triples = (((before * base + codes) * base + after) * spread + spread) * spread >> shift
    cells = np.concatenate([row * features + pairs.astype(np.int64), row * features + triples.astype(np.int64)])
    return np.bincount(cells, minlength=rows * features).reshape(rows, features), known


def weights(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of damped counts times inverse document frequency, of length one (or zero)."""
    made = np.log1p(counts).astype(np.float32) * idf
    size = np.sqrt((made * made).sum(axis=1, keepdims=True))
    return made / np.where(size > 0, size, 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    lowest: np.ndarray  # cosine below which a text is rejected, for each centroid
    idf: np.ndarray
    letters: Letters


def _row_parts(batch: pa.RecordBatch):
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(start, ROWS_AT_ONCE)


def document_frequencies(df: DataFrame, letters: Letters, features: int) -> DataFrame:
    """``feature`` and ``n``, the number of texts that hold it; feature -1 counts the texts."""
    schema = T.StructType([T.StructField("feature", T.LongType()), T.StructField("n", T.LongType())])

    def work():
        table = letters.table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.zeros(features, np.int64)
            for part in _row_parts(batch):
                found += (term_counts(*utf8(part.column("text")), table, features)[0] > 0).sum(axis=0)
            held = np.flatnonzero(found)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(held, -1)), pa.array(np.append(found[held], batch.num_rows))], names=["feature", "n"]
            )

        return step

    return map_texts(df.select("text"), work, schema).groupBy("feature").agg(F.sum("n").alias("n"))


def sample_counts(df: DataFrame, letters: Letters, features: int) -> DataFrame:
    """``label`` and the packed non-zero ``features`` and ``counts`` of each text."""
    schema = T.StructType([
        T.StructField("label", T.StringType()), T.StructField("features", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    ])

    def work():
        table = letters.table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = []
            for part in _row_parts(batch):
                for row in term_counts(*utf8(part.column("text")), table, features)[0]:
                    held = np.flatnonzero(row)
                    made.append((held.astype("<u4").tobytes(), row[held].astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([a for a, _ in made], pa.binary()), pa.array([b for _, b in made], pa.binary())],
                names=["label", "features", "counts"],
            )

        return step

    return map_texts(df.select("label", "text"), work, schema)


def cluster(rows: np.ndarray, clusters: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one by k-means over cosines, and each row's cosine to its own; starts far apart."""
    centres = [rows.mean(axis=0)]
    centres[0] /= max(np.linalg.norm(centres[0]), 1e-12)
    near = rows @ centres[0]
    while len(centres) < min(clusters, len(rows)):
        centres.append(rows[int(near.argmin())])
        near = np.maximum(near, rows @ centres[-1])
    centres = np.array(centres)
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        for k in range(len(centres)):
            if (own == k).any():
                mean = rows[own == k].mean(axis=0)
                centres[k] = mean / max(np.linalg.norm(mean), 1e-12)
    cosines = rows @ centres.T
    return centres, cosines


def fit(
    df: DataFrame,
    label: str = "lang",
    text: str = "text",
    features: int = FEATURES,
    clusters: int = CLUSTERS,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the rows that have a label and a text."""
    if features & (features - 1):
        raise ValueError("the number of features must be a power of two")
    known = df.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).where(
        "label is not null and text is not null"
    )
    letters = Letters()
    # Rows of each label and, by digest, its distinct texts; copies meet in their own task first.
    alike = known.groupBy("label", F.xxhash64("text", "label").alias("digest")).agg(F.count("*").alias("n"))
    counted = alike.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    found = counted.limit(MAX_LANGUAGES + 1).collect()
    sizes, texts = ({r["label"]: r[k] for r in found} for k in ("n", "texts"))
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    if not sizes:
        return LanguageModel([], np.zeros((0, features), np.float32), np.zeros(0), np.ones(features, np.float32), letters)
    counts = document_frequencies(known, letters, features).collect()  # one row for each feature
    held = np.zeros(features)
    for r in counts:
        if r["feature"] >= 0:
            held[r["feature"]] = r["n"]
    idf = (np.log((1 + sum(sizes.values())) / (1 + held)) + 1).astype(np.float32)
    # The distinct texts of a label get even draws up to their number; the smallest draws are taken.
    size = F.create_map(*[x for k, n in texts.items() for x in (F.lit(k), F.lit(float(n)))])
    draw = F.pmod(F.xxhash64("text", "label"), F.lit(1 << 40)) * size[F.col("label")] / (1 << 40)
    bound = sample_per_language * len(sizes)
    likely = known.withColumn("draw", draw).where(F.col("draw") <= 8.0 * sample_per_language)
    drawn = likely.dropDuplicates(["label", "text"]).orderBy("draw", "label", "text").limit(bound)
    sampled = sample_counts(drawn, letters, features)
    by_label: dict[str, list] = {}
    for r in sampled.collect():
        row = np.zeros(features, np.int64)
        row[np.frombuffer(r["features"], "<u4")] = np.frombuffer(r["counts"], "<u4")
        by_label.setdefault(r["label"], []).append(row)
    names, centroids, lowest = [], [], []
    for name in sorted(by_label):
        rows = weights(np.array(by_label[name]), idf)
        rows = rows[(rows != 0).any(axis=1)]
        if not len(rows):
            continue
        centres, cosines = cluster(rows, clusters)
        floor = REJECT_BELOW * float(np.quantile(cosines.max(axis=1), 0.01))
        names += [name] * len(centres)
        centroids.append(centres)
        lowest += [floor] * len(centres)
    if not names:
        return LanguageModel([], np.zeros((0, features), np.float32), np.zeros(0), idf, letters)
    return LanguageModel(names, np.concatenate(centroids).astype(np.float32), np.array(lowest), idf, letters)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns with ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``."""
    made = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    schema = with_fields(df, keep, made)
    names = [n for n, _ in made]
    kept = [f.name for f in schema.fields if f.name not in names]
    shared = df.sparkSession.sparkContext.broadcast(model)  # features by at most CLUSTERS * MAX_LANGUAGES

    def work():
        model = shared.value
        table = model.letters.table()
        features = len(model.idf)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            best, score, out = [], [], []
            for part in _row_parts(batch):
                counts, known = term_counts(*utf8(part.column(text)), table, features)
                if model.languages:
                    cosines = weights(counts, model.idf) @ model.centroids.T
                    own = cosines.argmax(axis=1)
                    value = np.clip(cosines[np.arange(len(own)), own], 0, 1)
                    best += [model.languages[k] if ok else UNDETERMINED for k, ok in zip(own.tolist(), known.tolist())]
                    score += np.where(known, value, 0).tolist()
                    out += (~known | (value < model.lowest[own])).tolist()
                else:
                    best += [UNDETERMINED] * len(known)
                    score += [0.0] * len(known)
                    out += [True] * len(known)
            values = {"lang_pred": pa.array(best, pa.string()), "score": pa.array(score, pa.float64()), "rejected": pa.array(out, pa.bool_())}
            return pa.RecordBatch.from_arrays(
                [values[f.name] if f.name in values else batch.column(f.name) for f in schema.fields], names=schema.names
            )

        return step

    return map_texts(df.select(*dict.fromkeys([*kept, text])), work, schema, text)


def held_out(doc_id: str = "doc_id"):
    """Whether the checksum of the id leaves remainder 1 when divided by 3; a missing id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learnable(df: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows with an id that are not held out."""
    return df.where(F.col(doc_id).isNotNull() & ~held_out(doc_id))
