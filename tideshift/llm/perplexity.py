"""Quality rules: counts over words and lines, and the perplexity of a character n-gram model.

The model is a modified Kneser-Ney model for each language. Spark counts the n-grams of all texts and derives the
lower orders, the discounts and the interpolated probabilities from them by aggregations and joins. The result is
stored as two sorted arrays of 64-bit hashes with their values (probabilities of n-grams and back-off weights of
contexts), looked up by binary search. An n-gram carries its language in its hash, so one array serves all.
For scoring, texts are lower-cased (A-Z), digits become 0, and white space becomes one space; texts start
with a border that predicts nothing and counts as context.

The model learns from all texts with at most ``SYMBOLS_PER_WORD`` symbols a word: text that is laced with symbols
would otherwise teach it to expect them.

A document is kept if it passes the base rules and its bits per character (the binary logarithm of its
perplexity) lie within the band of its language: from the median, ``BELOW`` times the distance to the first quartile
downwards and ``ABOVE`` times the distance to the third upwards, over all documents that pass the base rules.

Missing texts have no words and fail the base rules; missing languages form a language of their own. Rows that
repeat, also those without an id, are counted and judged each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import bounded_batches, map_texts, mix64, slices, utf8
from tideshift.session import settle

ORDER = 5
HELD_GRAMS = 400_000  # distinct n-grams that a task holds before it hands them on
MAX_MODEL_ROWS = 8_000_000  # n-grams and contexts sent to every worker (12 bytes each); larger models are joined
BELOW, ABOVE = 20.0, 20.0
SYMBOLS_PER_WORD = 0.1
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
BORDER = 0x110000  # no code point
BORDER_SHOWN = "\n"  # never inside a normalised text
FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)


# ---------------------------------------------------------------- base rules


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    code = mix64(np.arange(1, 257, dtype=np.uint64))
    return space, symbol, code


def _powers(n: int) -> np.ndarray:
    made = np.full(max(n, 1), FACTOR)
    made[0] = 1
    return np.multiply.accumulate(made)


def _run_hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of values; runs follow each other, and values between them are zero."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))[: len(values)]
    summed = np.add.reduceat(values * _powers(int(place.max()) + 1)[place], starts)
    return mix64(summed + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _repeated(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether it is the first of its (row, key), and how often that occurs."""
    joined = mix64(key + row.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    _, first, where, count = np.unique(joined, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(joined), bool)
    is_first[first] = True
    return is_first, count[where]


def base_counts(data: np.ndarray, offsets: np.ndarray, tables) -> dict[str, np.ndarray]:
    """Words, their code points, symbols, repeated lines and words in repeated three-word windows of each text."""
    space_of, symbol_of, code_of = tables
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    if not len(data):
        return {n: np.zeros(rows, np.int64) for n in names}
    per_row = lambda mask: np.bincount(row[mask], minlength=rows)
    space = space_of[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    word_start = ~space & (first | np.concatenate([[True], space[:-1]]))
    out = {
        "n_words": per_row(word_start),
        "word_chars": per_row(~space & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(symbol_of[data]),
    }
    codes = code_of[data]

    starts = np.flatnonzero(word_start)
    of_word = row[starts]
    lead = starts[0] if len(starts) else 0
    letters = np.where(space, np.uint64(0), codes)[lead:]
    lengths = np.add.reduceat((~space[lead:]).astype(np.int64), starts - lead) if len(starts) else starts
    words = _run_hashes(letters, starts - lead, lengths)
    out["n_repeat_words"] = np.zeros(rows, np.int64)
    if len(words) > 2:
        whole = np.flatnonzero(of_word[:-2] == of_word[2:])
        key = mix64(words[whole] + np.uint64(1)) + mix64(words[whole + 1] + np.uint64(2)) * FACTOR
        key += mix64(words[whole + 2] + np.uint64(3)) * FACTOR * FACTOR
        again = whole[_repeated(of_word[whole], key)[1] > 1]
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[again + k] = True
        out["n_repeat_words"] = np.bincount(of_word[covered], minlength=rows)

    feed = data == 10
    line_start = first | np.concatenate([[True], feed[:-1]])
    starts = np.flatnonzero(line_start)
    texts = np.add.reduceat((~space).astype(np.int64), starts) > 0
    lengths = np.add.reduceat((~feed).astype(np.int64), starts)
    lines = _run_hashes(np.where(feed, np.uint64(0), codes), starts, lengths)
    keep = np.flatnonzero(texts)
    is_first = _repeated(row[starts[keep]], lines[keep])[0]
    out["n_dup_lines"] = np.bincount(row[starts[keep[~is_first]]], minlength=rows)
    return out


# ---------------------------------------------------------------- n-grams


def normalised(texts: Sequence[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with borders before each, and the text of each code point."""
    gap = "\n" * (order - 1)
    joined = np.frombuffer((gap + gap.join(texts)).encode("utf-32-le", "replace"), np.uint32).copy()
    lengths = np.array([len(t) for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), lengths + order - 1)
    starts = np.concatenate([[0], np.cumsum(lengths + order - 1)[:-1]])
    border = np.zeros(len(joined), bool)
    for k in range(order - 1):
        border[starts + k] = True
    space = ((joined == 32) | ((joined >= 9) & (joined <= 13))) & ~border
    joined[space] = 32
    joined[(joined >= 65) & (joined <= 90)] += 32
    joined[(joined >= 48) & (joined <= 57)] = 48
    joined[joined == 0] = 0xFFFD
    joined[border] = BORDER
    keep = ~space | np.concatenate([[True], ~space[:-1]])
    return joined[keep], row[keep]


def language_key(name: str | None) -> int:
    return xxhash.xxh64_intdigest((name or "").encode(), 7)


def gram_hashes(codes: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` code points that end at each place from ``length - 1`` on."""
    made = np.zeros(len(codes) - length + 1, np.uint64)
    for k in range(length):
        made = made * FACTOR + codes[k : len(codes) - length + 1 + k].astype(np.uint64) + np.uint64(1)
    return mix64(made + keys[length - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(length))


def _row_keys(languages: list) -> np.ndarray:
    known = {name: language_key(name) for name in set(languages)}
    return np.array([known[name] for name in languages], np.uint64)


def _shown(grams: np.ndarray) -> list[str]:
    """Rows of code points as strings."""
    grams = np.where(grams == BORDER, np.uint32(ord(BORDER_SHOWN)), grams)
    return np.ascontiguousarray(grams).view(f"<U{grams.shape[1]}").ravel().tolist()


def _learnable(codes: np.ndarray, row: np.ndarray, rows: int, most: float) -> np.ndarray:
    """Which texts have at most ``most`` symbols a word."""
    symbols = np.bincount(row[np.isin(codes, list(SYMBOLS))], minlength=rows)
    return symbols <= most * (1 + np.bincount(row[codes == 32], minlength=rows))


def count_grams(df: DataFrame, order: int = ORDER, symbols_per_word: float = SYMBOLS_PER_WORD) -> DataFrame:
    """``lang``, ``gram`` and ``n`` of all n-grams of the highest order in the texts to learn from; borders show as
    line feeds."""
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []

        def merged(parts):
            keys, first, where = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            counts = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
            return keys, counts, np.concatenate([p[2] for p in parts])[first], np.concatenate([p[3] for p in parts])[first]

        def rows(held):
            return pa.RecordBatch.from_arrays(
                [pa.array(held[3], pa.string()), pa.array(_shown(held[2]), pa.string()), pa.array(held[1])], names=schema.names
            )

        for batch in batches:
            for piece in slices(batch, "text") if batch.num_rows else ():
                languages = piece.column("lang").to_pylist()
                codes, row = normalised(piece.column("text").fill_null("").to_pylist(), order)
                if len(codes) < order:
                    continue
                hashes = gram_hashes(codes, _row_keys(languages)[row], order)
                learn = _learnable(codes, row, len(languages), symbols_per_word)
                real = np.flatnonzero((codes[order - 1 :] != BORDER) & learn[row[order - 1 :]])
                if not len(real):
                    continue
                keys, first, counts = np.unique(hashes[real], return_index=True, return_counts=True)
                ends = real[first]
                grams = np.stack([codes[ends + k] for k in range(order)], axis=1)
                names = np.array(languages, object)[row[ends + order - 1]]
                held = merged([*([held] if held else []), (keys, counts, grams, names)])
                if len(held[0]) > HELD_GRAMS:
                    yield rows(held)
                    held = None
        if held:
            yield rows(held)

    bounded_batches(df.sparkSession)
    return df.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """Probabilities (``lang``, ``gram``, ``p``) and back-off weights (``lang``, ``context``, ``weight``), all orders.

    Lower orders count distinct left neighbours instead of occurrences. Discounts of each language and order come
    from how many n-grams have the counts 1 to 4.
    """
    tables = [settle(counts.select(F.coalesce("lang", F.lit("")).alias("lang"), "gram", "n"))]
    for length in range(order - 1, 0, -1):
        tables.append(settle(
            tables[-1].groupBy("lang", F.substring("gram", 2, length).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        ))
    probabilities, weights, lower = [], [], None
    for length, grams in zip(range(1, order + 1), reversed(tables)):
        of = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
        sums = grams.groupBy("lang").agg(*of, F.count(F.lit(1)).alias("types"))
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        # Too few n-grams for an estimate leave half of a count to the lower order.
        discount = lambda k: F.when(
            (F.col(f"n{k}") > 0) & y.isNotNull(),
            F.greatest(F.lit(0.0), F.least(F.lit(float(k)), k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")))),
        ).otherwise(0.5)
        sums = sums.select("lang", "types", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = grams.join(sums, "lang").select(
            "lang", "gram", "types", "n", cut.alias("cut"), F.substring("gram", 1, length - 1).alias("context")
        )
        contexts = settle(rows.groupBy("lang", "context").agg(
            F.sum("n").cast("double").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")
        ))
        rows = rows.join(contexts, ["lang", "context"])
        if lower is None:
            shorter = 1 / F.col("types")
        else:
            rows = rows.withColumn("rest", F.substring("gram", 2, length - 1)).join(
                lower.select("lang", F.col("gram").alias("rest"), F.col("p").alias("q")), ["lang", "rest"]
            )
            shorter = F.col("q")
        p = (F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * shorter
        lower = settle(rows.select("lang", "gram", p.alias("p")))
        probabilities.append(lower)
        weights.append(contexts.select("lang", "context", "weight"))
    return reduce(DataFrame.unionByName, probabilities), reduce(DataFrame.unionByName, weights)


def hashed(df: DataFrame, gram: str, value: str) -> DataFrame:
    """``hash`` (as a signed number) and ``bits`` (negative binary logarithm of the value) of each n-gram."""
    schema = T.StructType([T.StructField("hash", T.LongType()), T.StructField("bits", T.FloatType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            keys = _row_keys(batch.column("lang").to_pylist())
            lengths = np.array([len(g) for g in grams], np.int64)
            values = batch.column("value").to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                joined = "".join(grams[i] for i in own).encode("utf-32-le")
                codes = np.frombuffer(joined, np.uint32) if joined else np.zeros(0, np.uint32)
                codes = codes.reshape(len(own), length)
                codes = np.where(codes == ord(BORDER_SHOWN), np.uint32(BORDER), codes)
                made = np.zeros(len(own), np.uint64)
                for k in range(length):
                    made = made * FACTOR + codes[:, k].astype(np.uint64) + np.uint64(1)
                made = mix64(made + keys[own] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(length))
                bits = -np.log2(np.maximum(values[own], 1e-30))
                yield pa.RecordBatch.from_arrays([pa.array(made.view(np.int64)), pa.array(bits.astype(np.float32))], names=schema.names)

    return df.select("lang", F.col(gram).alias("gram"), F.col(value).alias("value")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """Sorted hashes with their values; ``None`` arrays stand for a model too large to send, to be joined."""

    order: int
    grams: DataFrame
    contexts: DataFrame
    arrays: tuple | None


def fit(df: DataFrame, order: int = ORDER, max_rows: int = MAX_MODEL_ROWS) -> Model:
    """Learn from all rows of ``df`` (columns ``lang`` and ``text``)."""
    probabilities, weights = kneser_ney(count_grams(df, order), order)
    grams, contexts = settle(hashed(probabilities, "gram", "p")), settle(hashed(weights, "context", "weight"))
    rows = grams.count() + contexts.count()
    return Model(order, grams, contexts, _sorted_arrays(grams, contexts) if rows <= max_rows else None)


def _sorted_arrays(grams: DataFrame, contexts: DataFrame) -> tuple:
    out = []
    for part in (grams, contexts):
        stored = part.toArrow()
        keys = stored.column("hash").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        out += [keys[order], stored.column("bits").to_numpy()[order]]
    return tuple(out)


class SortedHashes:
    """Binary search in sorted hashes, narrowed by a table over their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.bits = max(int(len(keys)).bit_length(), 1)
        edges = np.arange((1 << self.bits) + 1, dtype=np.float64) * 2.0 ** (64 - self.bits)
        self.first = np.append(np.searchsorted(keys, edges[:-1].astype(np.uint64)), len(keys)).astype(np.int32)
        widest = int(np.diff(self.first).max()) if len(keys) else 0
        self.steps = widest.bit_length()

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the wanted hashes (0 if absent), and which are present."""
        if not len(self.keys):
            return np.zeros(len(wanted), np.float32), np.zeros(len(wanted), bool)
        slot = (wanted >> np.uint64(64 - self.bits)).astype(np.int64)
        low, high = self.first[slot], self.first[slot + 1]
        for _ in range(self.steps):
            mid = (low + high) >> 1
            below = (low < high) & (self.keys[np.minimum(mid, len(self.keys) - 1)] < wanted)
            low, high = np.where(below, mid + 1, low), np.where(below, high, np.maximum(mid, low))
        at = np.minimum(low, len(self.keys) - 1)
        there = self.keys[at] == wanted
        return np.where(there, self.values[at], np.float32(0)), there


def context_hashes(codes: np.ndarray, keys: np.ndarray, length: int, order: int) -> np.ndarray:
    """Hashes of the first ``length - 1`` of ``length`` code points, for ends from ``order - 1`` on."""
    if length == 1:
        return mix64(keys[order - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F))
    return gram_hashes(codes[:-1], keys[:-1], length - 1)[order - length :]


def gram_bits(codes: np.ndarray, keys: np.ndarray, order: int, grams: SortedHashes, contexts: SortedHashes) -> np.ndarray:
    """Bits of the code point at each place from ``order - 1`` on, backing off to shorter contexts where needed."""
    n = len(codes) - order + 1
    bits = np.zeros(n, np.float64)
    open_ = np.arange(n)
    for length in range(order, 0, -1):
        hashes = gram_hashes(codes, keys, length)[order - length :]
        value, there = grams.find(hashes[open_] if len(open_) < n else hashes)
        bits[open_[there]] += value[there]
        open_ = open_[~there]
        if not len(open_):
            return bits
        # An unseen context has weight one; a seen one hands down its weight.
        seen = context_hashes(codes, keys, length, order)[open_]
        weight, there = contexts.find(seen)
        bits[open_] += np.where(there, weight, 0)
    bits[open_] += np.log2(BORDER)  # never seen: as likely as any code point
    return bits


# ---------------------------------------------------------------- scoring

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(df: DataFrame, model: Model) -> DataFrame:
    """Base counts of each row and the bits per character that the sorted arrays give."""
    keys = ["id", "lang", "digest"]
    schema = T.StructType([
        *[df.schema[n] for n in keys],
        *[T.StructField(n, T.LongType()) for n in STATS], T.StructField("n_predicted", T.LongType()), T.StructField("bits", T.DoubleType()),
    ])
    order = model.order
    shared = df.sparkSession.sparkContext.broadcast(model.arrays)  # at most MAX_MODEL_ROWS rows

    def work():
        arrays = shared.value
        grams, contexts = SortedHashes(*arrays[:2]), SortedHashes(*arrays[2:])
        tables = _tables()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = base_counts(*utf8(batch.column("text")), tables)
            languages = batch.column("lang").to_pylist()
            codes, row = normalised(batch.column("text").fill_null("").to_pylist(), order)
            total, count = np.zeros(len(languages)), np.zeros(len(languages), np.int64)
            if len(codes) >= order:
                bits = gram_bits(codes, _row_keys(languages)[row], order, grams, contexts)
                real = codes[order - 1 :] != BORDER
                total = np.bincount(row[order - 1 :][real], bits[real], minlength=len(languages))
                count = np.bincount(row[order - 1 :][real], minlength=len(languages))
            mean = total / np.maximum(count, 1)
            return pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keys], *[pa.array(made[n], pa.int64()) for n in STATS],
                 pa.array(count, pa.int64()), pa.array(mean, mask=count == 0)],
                names=schema.names,
            )

        return step

    return map_texts(df.select(*keys, "text"), work, schema)


def bands(scored: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """``lang``, ``lower`` and ``upper`` bits per character; quantiles come from counts of thousandths of a bit."""
    counts = scored.groupBy("lang", F.round(F.col("bits") * 1000).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    ordered = Window.partitionBy("lang").orderBy("bin")
    ranked = counts.withColumn("upto", F.sum("n").over(ordered)).withColumn(
        "total", F.sum("n").over(Window.partitionBy("lang"))
    )
    at = lambda q: (F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))) / 1000)
    found = ranked.groupBy("lang").agg(at(0.25).alias("low"), at(0.5).alias("mid"), at(0.75).alias("high"))
    # Quartiles count as a fortieth of a bit away at least.
    return found.select(
        "lang",
        (F.col("mid") - below * F.greatest(F.col("mid") - F.col("low"), F.lit(0.025))).alias("lower"),
        (F.col("mid") + above * F.greatest(F.col("high") - F.col("mid"), F.lit(0.025))).alias("upper"),
    )


def judge(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
          max_rows: int = MAX_MODEL_ROWS) -> DataFrame:
    """Base counts, ``base_failed``, ``bits``, the band of the language and ``kept`` for every row."""
    texts = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.xxhash64(text).alias("digest"),
        F.col(text).alias("text"),
    )
    model = fit(texts, order, max_rows)
    scored = measured(texts, model) if model.arrays else measured_by_join(texts, model)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = settle(scored.withColumn("base_failed", failed))
    limits = bands(scored.where(~F.col("base_failed")))
    inside = F.coalesce(F.col("bits").between(F.col("lower"), F.col("upper")), F.lit(False))
    return scored.join(limits, "lang", "left").select(
        F.col("id").alias(id_col), F.col("lang").alias("language"), *STATS, "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), "bits", "lower", "upper",
    )


def _resolved(grams: DataFrame, model: Model) -> DataFrame:
    """``bits`` of each distinct n-gram (``g5`` .. ``g1`` are the hashes of its endings, ``c5`` .. of their contexts)."""
    rows = grams.withColumn("bits", F.lit(None).cast("double")).withColumn("paid", F.lit(0.0))
    for length in range(model.order, 0, -1):
        own = model.grams.select(F.col("hash").alias(f"g{length}"), F.col("bits").cast("double").alias("found"))
        passed = model.contexts.select(F.col("hash").alias(f"c{length}"), F.col("bits").cast("double").alias("weight"))
        rows = rows.join(own, f"g{length}", "left").join(passed, f"c{length}", "left")
        rows = rows.withColumn("bits", F.coalesce("bits", F.col("paid") + F.col("found")))
        rows = rows.withColumn("paid", F.col("paid") + F.coalesce("weight", F.lit(0.0))).drop("found", "weight")
    never = F.col("paid") + F.log2(F.lit(float(BORDER)))
    return rows.select(f"g{model.order}", F.coalesce("bits", never).alias("bits"))


def measured_by_join(df: DataFrame, model: Model) -> DataFrame:
    """As ``measured`` for models of any size: distinct n-grams of each text are joined with the model tables."""
    order = model.order
    nothing = tuple(np.zeros(0, t) for t in (np.uint64, np.float32) * 2)
    base = measured(df, replace(model, arrays=nothing)).drop("bits", "n_predicted")
    hashes = [f"{kind}{n}" for kind in "gc" for n in range(order, 0, -1)]
    keys = ["id", "lang", "digest"]
    schema = T.StructType([*[df.schema[n] for n in keys], T.StructField("times", T.LongType()),
                           *[T.StructField(n, T.LongType()) for n in hashes]])

    def work():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            codes, row = normalised(batch.column("text").fill_null("").to_pylist(), order)
            key = _row_keys(batch.column("lang").to_pylist())[row]
            real = np.flatnonzero(codes[order - 1 :] != BORDER)
            made = {}
            for n in range(order, 0, -1):
                made[f"g{n}"] = gram_hashes(codes, key, n)[order - n :][real]
                made[f"c{n}"] = context_hashes(codes, key, n, order)[real]
            rows = row[order - 1 :][real]
            whole = made[f"g{order}"]
            by = np.lexsort((whole, rows))
            new = np.ones(len(by), bool)
            new[1:] = (whole[by][1:] != whole[by][:-1]) | (rows[by][1:] != rows[by][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(by)))
            picked = pa.array(rows[by][first])
            return pa.RecordBatch.from_arrays(
                [*[batch.column(n).take(picked) for n in keys], pa.array(times, pa.int64()),
                 *[pa.array(made[n][by][first].view(np.int64)) for n in hashes]], names=schema.names,
            )

        return step

    grams = settle(map_texts(df, work, schema))
    bits = _resolved(grams.select(*hashes).distinct(), model)
    found = grams.select(*keys, "times", f"g{order}").join(bits, f"g{order}").groupBy(*keys).agg(
        F.sum("times").alias("n_predicted"), F.sum(F.col("times") * F.col("bits")).alias("sum")
    )
    # Rows that repeat share their key, and both sums grow alike.
    same = base["id"].eqNullSafe(found["id"]) & (base["lang"] == found["lang"]) & (base["digest"] == found["digest"])
    return base.join(found, same, "left").select(
        *[base[n] for n in (*keys, *STATS)], "n_predicted", (F.col("sum") / F.col("n_predicted")).alias("bits")
    )
