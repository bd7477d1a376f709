"""Toxicity by multiple-instance learning: a document is a bag of sentences, and only the bag has a label.

A sentence's logit is a bias plus the values of its distinct words; a word's value is the sum of the weights of its
character n-grams (with marks at its ends) and of the word itself, hashed into a fixed number of features, so that
unseen inflections of a known stem count too. Sentence probabilities combine by noisy-or: a document is clean only if all its
sentences are. The likelihood of the document labels is maximised with respect to the weights; its gradient shares the
blame for a toxic document out among its sentences by their own probabilities, so the model learns which of them it was, though no
sentence ever had a label, and the same probabilities locate the offending sentences afterwards.

Only features that stand in clearly more toxic documents than chance would put there take part (``MIN_EXCESS`` standard
deviations): in an open vocabulary the others could only learn the training documents by heart.

The fit takes about ``SAMPLE_PER_LABEL`` documents of each label, drawn by a digest of the id among all labelled rows;
it weighs them by how many they stand for. Their features are stored once in blocks; each round is one narrow job over
the blocks, and the driver sees one gradient for each of at most ``BLOCK_TASKS`` tasks.

Missing and empty texts and texts without a letter are one sentence without words, scored by the bias alone. Without any labelled row
all scores are 0. An id that is labelled twice counts as toxic if one label says so; labels other than 0 and 1 and missing ones
teach nothing. Equal texts get equal scores. A kept column gives way to a made one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import char_offsets, codepoints, map_texts, mix64, utf8, with_fields
from tideshift.llm.langid import Letters
from tideshift.session import settle

SAMPLE_PER_LABEL = 4000
FEATURES = 1 << 17
GRAMS = (3, 4, 5, 6)
ROUNDS = 40
STEP = 0.4
PENALTY = 2e-5
BIAS = -5.0
MIN_EXCESS = 3.0
THRESHOLD = 0.7
LOCATE_FROM = 0.5
BLOCK_TASKS = 8
ROWS_A_TASK = 500  # sampled documents that a task of a round takes, up to BLOCK_TASKS tasks
SENTENCE_ENDS = ".!?\n。！？"
START, END = 2, 3  # marks at the ends of a word; no letters


@dataclass(frozen=True)
class Sentences:
    """Sentences of several texts, their distinct words, and the features of these."""

    row: np.ndarray  # text of each sentence
    begin: np.ndarray  # first code point of each sentence in its text
    end: np.ndarray
    sentence: np.ndarray  # of each pair of a sentence and a distinct word of it
    word: np.ndarray
    first: np.ndarray  # where the features of each word start
    feature: np.ndarray

    def values(self, weights: np.ndarray) -> np.ndarray:
        """The value of each word."""
        sizes = np.diff(np.append(self.first, len(self.feature)))
        sums = np.add.reduceat(weights[self.feature], self.first) if len(self.first) else np.zeros(0)
        return sums / np.sqrt(sizes)

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.sentence, self.values(weights)[self.word], minlength=len(self.row))


def _cells(hashes: np.ndarray, features: int) -> np.ndarray:
    return (mix64(hashes) >> np.uint64(65 - int(features).bit_length())).astype(np.int64)


def _marked(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for each pair of a code point and a place, to be summed over a word or n-gram."""
    return mix64((codes.astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(1))


def split(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, features: int) -> Sentences:
    """Cut texts (UTF-8 bytes with row offsets) into sentences and words."""
    rows = len(offsets) - 1
    raw = codepoints(data)
    bounds = char_offsets(data, offsets)
    codes = letters[raw]
    row = np.repeat(np.arange(rows), np.diff(bounds))
    ends = np.isin(raw, np.array([ord(c) for c in SENTENCE_ENDS], np.uint32))
    # Sentences are numbered through all texts; a text starts a new one.
    starts = np.zeros(len(raw), bool)
    starts[1:] = ends[:-1]
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    number = np.cumsum(starts) - 1
    letter = codes != 32
    begins = letter.copy()
    begins[1:] &= ~letter[:-1] | (number[1:] != number[:-1])
    place = np.flatnonzero(letter)
    first = np.flatnonzero(begins[place])
    word_of = np.cumsum(begins[place]) - 1
    inside = np.arange(len(place)) - first[word_of] if len(place) else place
    spelled = codes[place]
    hashes = np.add.reduceat(_marked(spelled, inside), first) if len(first) else np.zeros(0, np.uint64)
    distinct, sample, word = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = np.diff(np.append(first, len(place)))

    # The features of each distinct word, from one place where it stands.
    size = lengths[sample] + 2
    at = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(distinct)), size)
    inner = np.arange(len(owner)) - at[owner] if len(owner) else owner
    text = np.full(len(owner), START, np.uint64)
    text[at + size - 1] = END
    middle = (inner > 0) & (inner < size[owner] - 1)
    text[middle] = spelled[first[sample][owner[middle]] + inner[middle] - 1]
    owners, cells = [np.arange(len(distinct))], [_cells(distinct, features)]
    for n in GRAMS:
        whole = np.flatnonzero(inner + n <= size[owner])
        gram = np.full(len(whole), np.uint64(n) << np.uint64(56))
        for k in range(n):
            gram += _marked(text[whole + k], np.full(len(whole), k))
        owners.append(owner[whole])
        cells.append(_cells(gram, features))
    owners, cells = np.concatenate(owners), np.concatenate(cells)
    order = np.argsort(owners, kind="stable")
    feature_first = np.searchsorted(owners[order], np.arange(len(distinct)))

    # Sentences that hold a word, and one without words for each text that has none.
    of_word = number[place[first]] if len(first) else np.zeros(0, np.int64)
    pairs = np.unique(of_word * max(len(distinct), 1) + word)
    held, sentence = np.unique(pairs // max(len(distinct), 1), return_inverse=True)
    begin_of = np.flatnonzero(starts)
    end_of = np.append(begin_of[1:], len(raw))
    owner_row = row[begin_of[held]] if len(held) else np.zeros(0, np.int64)
    silent = np.setdiff1d(np.arange(rows), owner_row)
    return Sentences(
        np.concatenate([owner_row, silent]),
        np.concatenate([begin_of[held] - bounds[owner_row], np.zeros(len(silent), np.int64)]),
        np.concatenate([end_of[held] - bounds[owner_row], np.zeros(len(silent), np.int64)]),
        sentence.reshape(-1),
        pairs % max(len(distinct), 1),
        feature_first,
        cells[order],
    )


def noisy_or(logits: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each sentence, and that of each text: one minus the chance that all its sentences are clean."""
    chance = 1 / (1 + np.exp(-logits))
    clean = np.bincount(row, -np.logaddexp(0, logits), minlength=rows)
    return chance, -np.expm1(clean)


def gradient(bags: Sentences, toxic: np.ndarray, weight: np.ndarray, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float, float]:
    """Gradient of the negative log likelihood of the labels with respect to the weights and the bias, and its value."""
    chance, total = noisy_or(bags.logits(weights, bias), bags.row, len(toxic))
    total = np.clip(total, 1e-12, 1 - 1e-12)
    blame = np.where(toxic, -(1 - total) / total, 1.0) * weight
    by_sentence = blame[bags.row] * chance
    sizes = np.diff(np.append(bags.first, len(bags.feature)))
    by_word = np.bincount(bags.word, by_sentence[bags.sentence], minlength=len(bags.first)) / np.sqrt(sizes)
    by_feature = np.bincount(bags.feature, np.repeat(by_word, sizes), minlength=len(weights))
    loss = float((weight * np.where(toxic, -np.log(total), -np.log1p(-total))).sum())
    return by_feature, float(by_sentence.sum()), loss


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    letters: Letters
    losses: tuple[float, ...] = ()


def sampled(docs: DataFrame, labels: DataFrame, per_label: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``text``, ``toxic`` and ``weight`` of about ``per_label`` distinct documents of each label."""
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col(doc_id).alias("id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {y: min(1.0, per_label / n) for y, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 40)) / (1 << 40)
    chosen = known.where(F.lit(False) if not rate else F.when(F.col("toxic") == 1, draw < rate.get(1, 0.0)).otherwise(draw < rate.get(0, 0.0)))
    share = F.when(F.col("toxic") == 1, 1 / rate.get(1, 1.0)).otherwise(1 / rate.get(0, 1.0))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # About 2 * per_label ids are sent, however many documents there are.
    return rows.join(F.broadcast(chosen), "id").select("text", "toxic", share.alias("weight")).dropDuplicates(["text", "toxic"])


PARTS = (("row", np.int32), ("sentence", np.int32), ("word", np.int32), ("first", np.int64), ("feature", np.int32))


def blocks(rows: DataFrame, letters: Letters, features: int) -> DataFrame:
    """The sampled rows as packed features: one row for each slice of texts."""
    schema = T.StructType([T.StructField(n, T.BinaryType()) for n, _ in PARTS] + [T.StructField(n, T.BinaryType()) for n in ("toxic", "weight")])

    def work():
        table = letters.table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bags = split(*utf8(batch.column("text")), table, features)
            packed = [getattr(bags, n).astype(kind).tobytes() for n, kind in PARTS]
            packed += [batch.column("toxic").to_numpy().astype(bool).tobytes(), batch.column("weight").to_numpy().astype(np.float64).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in packed], names=schema.names)

        return step

    dealt = rows.repartition(BLOCK_TASKS, F.xxhash64("text"))
    return map_texts(dealt, work, schema)


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[Sentences, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        part = {n: np.frombuffer(batch.column(n)[i].as_buffer(), kind) for n, kind in PARTS}
        none = np.zeros(0, np.int64)
        toxic, weight = (np.frombuffer(batch.column(n)[i].as_buffer(), kind) for n, kind in (("toxic", bool), ("weight", np.float64)))
        yield Sentences(part["row"], none, none, part["sentence"], part["word"], part["first"], part["feature"]), toxic, weight


def summed(stored: DataFrame, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float, float]:
    """One round: the gradient and the loss over all blocks."""
    schema = T.StructType([T.StructField("gradient", T.BinaryType()), T.StructField("bias", T.DoubleType()), T.StructField("loss", T.DoubleType())])
    shared = stored.sparkSession.sparkContext.broadcast(weights)  # FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, by_bias, loss = np.zeros(len(shared.value)), 0.0, 0.0
        for batch in batches:
            for bags, toxic, weight in unpacked(batch):
                g, b, value = gradient(bags, toxic, weight, shared.value, bias)
                total, by_bias, loss = total + g, by_bias + b, loss + value
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.astype(np.float32).tobytes()], pa.binary()), pa.array([by_bias]), pa.array([loss])], names=schema.names
        )

    parts = stored.mapInArrow(run, schema).collect()
    shared.destroy()
    return sum(np.frombuffer(r["gradient"], np.float32).astype(float) for r in parts), sum(r["bias"] for r in parts), sum(r["loss"] for r in parts)


def document_counts(stored: DataFrame, features: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """In how many toxic and in how many clean documents of the blocks each feature stands, and how many there are."""
    schema = T.StructType([T.StructField("held", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros((2, features), np.int32), [0, 0]
        for batch in batches:
            for bags, toxic, _ in unpacked(batch):
                words = max(len(bags.first), 1)
                pairs = np.unique(bags.row[bags.sentence].astype(np.int64) * words + bags.word)
                row, word = pairs // words, pairs % words
                sizes = np.diff(np.append(bags.first, len(bags.feature)))[word]
                starts = np.cumsum(sizes) - sizes
                feature = bags.feature[np.repeat(bags.first[word] - starts, sizes) + np.arange(sizes.sum())]
                seen = np.unique(np.repeat(row, sizes) * features + feature)
                for y in (0, 1):
                    held[y] += np.bincount(seen[toxic[seen // features] == y] % features, minlength=features).astype(np.int32)
                    n[y] += int((toxic == y).sum())
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array([held[y].tobytes()], pa.binary()), pa.array([n[y]]), pa.array([bool(y)])], names=schema.names)

    parts = stored.mapInArrow(run, schema).collect()
    sums = [sum((np.frombuffer(r["held"], np.int32).astype(float) for r in parts if r["toxic"] == y), np.zeros(features)) for y in (False, True)]
    return sums[1], sums[0], *(sum(r["n"] for r in parts if r["toxic"] == y) for y in (True, False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    per_label: int = SAMPLE_PER_LABEL,
    features: int = FEATURES,
    rounds: int = ROUNDS,
) -> ToxicityModel:
    """Learn from the labelled documents; ``labels`` has the id and ``toxic`` (0 or 1)."""
    if features & (features - 1):
        raise ValueError("the number of features must be a power of two")
    letters = Letters()
    stored = settle(blocks(sampled(docs, labels, per_label, doc_id, text), letters, features))
    total = (stored.select(F.sum(F.length("weight")).alias("bytes")).first()["bytes"] or 0) / 8
    if not total:
        return ToxicityModel(np.zeros(features), -np.inf, letters)
    stored = stored.coalesce(min(BLOCK_TASKS, 1 + int(total) // ROWS_A_TASK))

    def fresh(weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        g, b, loss = summed(stored, weights, bias)
        losses.append(loss)
        return np.append(np.where(used, g + PENALTY * scale * weights, 0), b) / scale

    in_toxic, in_clean, n_toxic, n_clean = document_counts(stored, features)
    expected = (in_toxic + in_clean) * n_toxic / (n_toxic + n_clean)
    used = (in_toxic - expected) / np.sqrt(expected + 1) >= MIN_EXCESS
    losses: list[float] = []
    known = np.append(np.zeros(features), BIAS)
    # Adaptive steps: running means of the gradient and of its square.
    mean, square = np.zeros(features + 1), np.zeros(features + 1)
    scale = total
    for turn in range(1, rounds + 1):
        g = fresh(known[:-1], float(known[-1]))
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        rate = STEP * (1 - 0.9 * (turn - 1) / rounds)
        known = known - rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    return ToxicityModel(known[:-1], float(known[-1]), letters, tuple(losses))


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])


def judge(df: DataFrame, model: ToxicityModel, text: str = "text", keep: Sequence[str] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns with ``score``, ``predicted``, ``n_sentences`` (that hold a word) and ``offending``: in documents found
    toxic, the sentences (code points from ``start`` up to ``end``) that are at least as likely toxic as not, or else the worst."""
    made = [("score", T.DoubleType()), ("predicted", T.IntegerType()), ("n_sentences", T.LongType()), ("offending", T.ArrayType(SPAN))]
    schema = with_fields(df, keep, made)
    kept = [f.name for f in schema.fields if f.name not in dict(made)]
    shared = df.sparkSession.sparkContext.broadcast(model.weights)  # FEATURES numbers
    bias, letters = model.bias, model.letters

    def work():
        weights, table = shared.value, letters.table()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bags = split(*utf8(batch.column(text)), table, len(weights))
            chance, score = noisy_or(bags.logits(weights, bias), bags.row, batch.num_rows)
            worst = np.full(batch.num_rows, -1.0)
            np.maximum.at(worst, bags.row, chance)
            toxic = score >= threshold
            said = toxic[bags.row] & (bags.end > 0) & (chance >= np.minimum(LOCATE_FROM, worst[bags.row]))
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(said).tolist():
                spans[bags.row[i]].append({"start": int(bags.begin[i]), "end": int(bags.end[i]), "score": float(chance[i])})
            columns = {
                "score": pa.array(score),
                "predicted": pa.array(toxic.astype(np.int32)),
                "n_sentences": pa.array(np.bincount(bags.row[bags.end > 0], minlength=batch.num_rows).astype(np.int64)),
                "offending": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
            }
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else batch.column(f.name) for f in schema.fields], names=schema.names
            )

        return step

    return map_texts(df.select(*dict.fromkeys([*kept, text])), work, schema, text)
