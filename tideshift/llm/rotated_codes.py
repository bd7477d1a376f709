"""Approximate nearest neighbours by inner product from randomly rotated one-bit codes.

Every row belongs to the cell of its nearest centroid; centroids come from a bounded sample, their number grows with the
rows. What is left of a vector beyond its centroid is turned by a fixed random rotation (into ``MIN_BITS`` dimensions at
least) and kept as the signs of its coordinates, packed to bits, with two correction scalars: its length, and the inner
product of its direction with the signs' direction. From the bits alone that gives an unbiased estimate of the inner
product with a query and a bound on its error. With ``ERROR_FACTOR`` standard errors the bound fails about once in two
thousand pairs.

Cells are stored once, in pieces of bounded size with codes, scalars and vectors; a cell that holds many rows has many
pieces. Queries stand in blocks by their own cell. A first pass searches one piece of that cell, so that each query has
``k`` exact scores and with the last of them a bar. The second pass sends a block of queries to every other piece that may
hold more: a cell stays out for a query whose inner product with the centroid plus its length times the cell's radius is
below the bar, which loses nothing. Inside a piece the ``2 k`` best estimates are scored exactly, the bar rises to the k-th
of them, and only vectors whose upper bound reaches it are scored exactly too. Pieces keep their place: queries
travel, vectors do not.

On vectors with structure most cells stay out. On vectors without any (directions drawn evenly in many dimensions) no
cell can, and the codes alone decide what is scored.

Vectors that are missing, zero, or hold missing or non-finite components take no part, neither do vectors of another
length than the most frequent one (the longer one on a tie). Rows that repeat an id are candidates each for itself; a query's own row is known by its id,
so other rows of that id are no candidates of it, and a query id that repeats is searched for each of its rows' vectors
once they differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import bounded_batches
from tideshift.session import settle

K = 20
ERROR_FACTOR = 3.3
MIN_BITS = 512  # of a code; vectors of more components have a bit for each
BLOCK_BYTES = 2 << 20  # of vectors in a piece of a cell, as doubles
QUERY_BYTES = 1 << 20
QUERIES_AT_ONCE = 128
QUERY_BLOCKS = 64  # that one task takes to a piece
CENTROID_BYTES = 8 << 20  # bounds the number of cells; beyond it cells have more pieces
SAMPLE_BYTES = 32 << 20  # bounds the sample that centroids are made from
SAMPLE_PER_CELL = 32
ROUNDS = 6  # of moving centroids
SEED = 5


def rotation(dimension: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of the dimension, padded to at least ``MIN_BITS`` and whole bytes of bits."""
    width = -(-max(dimension, MIN_BITS) // 8) * 8
    made, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return (made * np.sign(np.diag(upper)))[:dimension]


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the turned directions, lengths, and inner products of directions with their signs' directions.

    A vector of length zero has an estimate of zero without error.
    """
    length = np.linalg.norm(vectors, axis=1)
    turned = (vectors / np.where(length > 0, length, 1)[:, None]) @ turn
    kept = np.where(length > 0, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1]), 1.0)
    return np.packbits(turned > 0, axis=1), length, kept


def signs_of(codes: np.ndarray) -> np.ndarray:
    """Packed bits as rows of -1 and 1."""
    return np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1


def estimates(codes: np.ndarray, length: np.ndarray, kept: np.ndarray, queries: np.ndarray, turn: np.ndarray, signs: np.ndarray | None = None):
    """Estimated inner products (queries by codes) and the standard error of each; ``signs`` may be given unpacked."""
    width = turn.shape[1]
    signs = signs_of(codes) if signs is None else signs
    total = (queries @ turn).astype(np.float32) @ signs.T
    scale = (length / (kept * np.sqrt(width))).astype(np.float32)
    size = np.linalg.norm(queries, axis=1)
    spread = length * np.sqrt(np.maximum(1 / kept**2 - 1, 0) / max(width - 1, 1))
    return total * scale, (size[:, None] * spread).astype(np.float32)


class Piece:
    """Rows of one cell with their codes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, center: np.ndarray, codes: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.ids, self.vectors, self.center, self.codes = ids, vectors, center, codes
        self.signs = signs_of(codes[0])
        self.longest = float(np.linalg.norm(vectors, axis=1).max(initial=0))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, bars: np.ndarray, turn: np.ndarray, k: int):
        """The best ``k`` for each query that reach its bar: positions of query and vector, and the exact score; then
        the number of pairs scored exactly."""
        out, scored = [], 0
        for start in range(0, len(queries), QUERIES_AT_ONCE):
            part = queries[start : start + QUERIES_AT_ONCE]
            guess, error = estimates(*self.codes, part, turn, self.signs)
            guess += (part @ self.center).astype(np.float32)[:, None]
            own = query_ids[start : start + QUERIES_AT_ONCE, None] == self.ids[None, :]
            guess[own] = -np.inf
            # What single precision may have lost in an estimate, and a sum in another order in a score.
            slack = 1e-5 * np.linalg.norm(part, axis=1) * self.longest
            bar = bars[start : start + QUERIES_AT_ONCE] - slack
            if len(self.ids) > 2 * k:
                first = np.argpartition(guess, len(self.ids) - 2 * k, axis=1)[:, -2 * k :]
                score = np.einsum("qd,qvd->qv", part, self.vectors[first])
                score[np.take_along_axis(own, first, axis=1)] = -np.inf
                bar = np.maximum(bar, np.partition(score, k, axis=1)[:, k] - slack)
            q, v = np.nonzero((guess + ERROR_FACTOR * error >= bar[:, None]) & ~own)
            score = np.einsum("ij,ij->i", part[q], self.vectors[v])
            scored += len(q)
            fine = score >= bar[q]
            q, v, score = q[fine], v[fine], score[fine]
            order = np.lexsort((self.ids[v], -score, q))
            q, v, score = q[order], v[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            best = place < k
            out.append((q[best] + start, v[best], score[best]))
        return *(np.concatenate(x) for x in zip(*out)), scored


def cells_of(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector, the first on a tie."""
    half = (centers**2).sum(axis=1) / 2
    return np.concatenate([np.argmax(vectors[i : i + 4096] @ centers.T - half, axis=1) for i in range(0, len(vectors), 4096)] or [np.zeros(0, int)])


def centroids(sample: np.ndarray, count: int, seed: int = SEED) -> np.ndarray:
    """``count`` centroids of the sample at most; equal vectors start one of them only."""
    distinct = np.unique(sample, axis=0)
    centers = distinct[np.sort(np.random.default_rng(seed).permutation(len(distinct))[:count])]
    for _ in range(ROUNDS):
        cell = cells_of(sample, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, cell, sample)
        n = np.bincount(cell, minlength=len(centers))
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def usable(embedding: Column) -> Column:
    """Whether a vector takes part: there, finite in every component, and not zero."""
    x = embedding.cast("array<double>")
    infinite = float("inf")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (v < infinite) & (v > -infinite))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def packed(rows: DataFrame, block: str) -> DataFrame:
    """One row for each block: ``ids`` and ``vectors`` as bytes of 64-bit integers and doubles."""
    schema = T.StructType([rows.schema[block], T.StructField("ids", T.BinaryType()), T.StructField("vectors", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> pa.RecordBatch:
            table = pa.concat_tables(held)
            vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return pa.RecordBatch.from_arrays(
                [pa.array([table.column(block)[0].as_py()], pa.int64()), pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
                 pa.array([vectors.astype(np.float64).tobytes()], pa.binary())], names=schema.names,
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            blocks = table.column(block).to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and held[0].column(block)[0].as_py() != blocks[a]:
                    yield flush()
                    held = []
                held.append(table.slice(a, b - a))
        if held:
            yield flush()

    return rows.repartition(block).sortWithinPartitions(block, "id").mapInArrow(run, schema)


def vectors_of(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def with_cell(rows: DataFrame, centers: np.ndarray) -> DataFrame:
    """``rows`` with their ``cell`` and their distance ``away`` from its centroid."""
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = vectors_of(batch.column("v"), centers.shape[1])
            cell = cells_of(vectors, centers)
            away = np.linalg.norm(vectors - centers[cell], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(away)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _matrix(data: bytes, dimension: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, dimension)


def coded(blocks: DataFrame, centers: np.ndarray, cell_of_piece: np.ndarray, seed: int) -> DataFrame:
    """Packed pieces with ``codes``, ``length`` and ``kept`` of what lies beyond the cell's centroid."""
    schema = T.StructType([*blocks.schema.fields, *[T.StructField(c, T.BinaryType()) for c in ("codes", "length", "kept")]])
    dimension = centers.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dimension, seed)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                vectors = _matrix(one.column("vectors")[0].as_py(), dimension)
                made = encode(vectors - centers[cell_of_piece[one.column("piece")[0].as_py()]], turn)
                yield pa.RecordBatch.from_arrays([*one.columns, *[pa.array([m.tobytes()], pa.binary()) for m in made]], names=schema.names)

    return blocks.mapInArrow(run, schema)


def meet(index: DataFrame, asking: DataFrame, tasks: int, centers: np.ndarray, cell_of_piece: np.ndarray, k: int, seed: int) -> DataFrame:
    """``query_id``, ``id``, ``score`` and the query's ``qb`` and ``at`` (its place there): the best of each piece and query.

    Both sides are dealt by piece and ``salt``, in as many tasks as asked for, and joined where they are.
    """
    dimension = centers.shape[1]
    schema = T.StructType(
        [T.StructField(c, t) for c, t in (("query_id", T.LongType()), ("id", T.LongType()), ("score", T.DoubleType()),
                                          ("qb", T.LongType()), ("at", T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dimension, seed)
        last, piece = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["piece"] != last:
                    length, kept = (np.frombuffer(row[c], np.float64) for c in ("length", "kept"))
                    codes = np.frombuffer(row["codes"], np.uint8).reshape(len(length), -1)
                    center = centers[cell_of_piece[row["piece"]]]
                    piece = Piece(np.frombuffer(row["ids"], np.int64), _matrix(row["vectors"], dimension), center, (codes, length, kept))
                    last = row["piece"]
                query_ids, bars = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["bars"], np.float64)
                queries, chosen = _matrix(row["queries"], dimension), np.frombuffer(row["chosen"], np.int32)
                q, v, score, _ = piece.search(query_ids[chosen], queries[chosen], bars[chosen], turn, k)
                at = chosen[q]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[at]), pa.array(piece.ids[v]), pa.array(score), pa.array(np.full(len(q), row["qb"], np.int64)), pa.array(at)],
                    names=schema.names,
                )

    left, right = (x.repartition(tasks, "piece", "salt") for x in (index, asking))
    return left.hint("merge").join(right, ["piece", "salt"]).mapInArrow(run, schema)


def visits(blocks: DataFrame, centers: np.ndarray, radius: np.ndarray, first_piece: np.ndarray, salts: int, home: bool) -> DataFrame:
    """Blocks of queries once for each piece they go to, and the queries ``chosen`` there.

    At ``home`` that is one piece of their own cell and every query; later, with ``bars``, all other pieces that may reach them.
    """
    dimension = centers.shape[1]
    names = ("query_ids", "queries", "bars", "chosen")
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("piece", "salt", "qb")], *[T.StructField(c, T.BinaryType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries = _matrix(row["vectors"], dimension)
                bars = np.full(len(queries), -np.inf) if home else np.frombuffer(row["bars"], np.float64)
                size = np.linalg.norm(queries, axis=1)
                own = int(cells_of(queries[:1], centers)[0])  # a block's queries have one cell
                first = int(first_piece[own] + row["qb"] % (first_piece[own + 1] - first_piece[own]))
                if home:
                    targets = [(first, np.arange(len(queries), dtype=np.int32))]
                else:
                    targets = []
                    for cell in np.flatnonzero(np.diff(first_piece)):
                        most = queries @ centers[cell] + size * radius[cell]
                        slack = 1e-9 * size * (np.linalg.norm(centers[cell]) + radius[cell])
                        chosen = np.flatnonzero(most >= bars - slack).astype(np.int32)
                        if len(chosen):
                            targets += [(p, chosen) for p in range(int(first_piece[cell]), int(first_piece[cell + 1])) if p != first]
                for piece, chosen in targets:
                    values = [piece, row["qb"] % salts, row["qb"], row["ids"], row["vectors"], bars.tobytes(), chosen.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, [pa.int64()] * 3 + [pa.binary()] * 4)], names=schema.names)

    return blocks.mapInArrow(run, schema)


def with_bars(blocks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Blocks with ``bars``: the k-th exact score found for each query, or minus infinity."""
    kth = found.groupBy("qb", "at").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar")).where(F.col("n") >= k)
    listed = kth.groupBy("qb").agg(F.collect_list("at").alias("at"), F.collect_list("bar").alias("bar"))  # a block's queries at most
    schema = T.StructType([*blocks.schema.fields, T.StructField("bars", T.BinaryType())])
    kept = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bars = []
            for row in batch.select(["ids", "at", "bar"]).to_pylist():
                own = np.full(len(row["ids"]) // 8, -np.inf)
                own[np.array(row["at"] or [], int)] = row["bar"] or []
                bars.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(bars, pa.binary())], names=schema.names)

    return blocks.join(listed, "qb", "left").mapInArrow(run, schema)


def nearest(
    df: DataFrame, query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K, block_vectors: int | None = None,
    block_queries: int | None = None, seed: int = SEED,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the neighbour's id (named as ``id_col``) and ``score`` for the rows where ``query`` holds."""
    spark = df.sparkSession
    bounded_batches(spark)
    fine = df.where(usable(F.col(vector)) & F.col(id_col).isNotNull())
    rows = fine.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"), query.alias("asks"))
    rows = rows.withColumn("d", F.size("v"))
    sizes = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("q"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    out = f"query_id long, rank int, `{id_col}` long, score double"
    if not common or not common[0]["q"]:
        return spark.createDataFrame([], out)
    dimension, n, asked = common[0]
    block_vectors = block_vectors or max(4 * k, BLOCK_BYTES // (8 * dimension))
    block_queries = block_queries or max(16, QUERY_BYTES // (8 * dimension))
    rows = rows.where(F.col("d") == dimension).select("id", "v", "asks")
    digest = F.xxhash64("id", "v")

    cells = max(1, min(-(-n // block_vectors), CENTROID_BYTES // (8 * dimension)))
    drawn = max(1, min(cells * SAMPLE_PER_CELL, SAMPLE_BYTES // (8 * dimension)))
    sample = rows.select("v", digest.alias("h")).orderBy("h", "v").limit(drawn).toArrow()  # at most SAMPLE_BYTES
    centers = centroids(vectors_of(sample.column("v").combine_chunks(), dimension), cells, seed)

    placed = with_cell(rows, centers)
    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r"), F.count_if("asks").alias("q")).collect()  # a row a cell
    pieces, radius, asking = np.zeros(len(centers), np.int64), np.zeros(len(centers)), np.zeros(len(centers), np.int64)
    for r in counts:
        pieces[r["cell"]], radius[r["cell"]], asking[r["cell"]] = -(-r["n"] // block_vectors), r["r"], -(-r["q"] // block_queries)
    first_piece, first_block = (np.concatenate([[0], np.cumsum(x)]) for x in (pieces, asking))
    cell_of_piece = np.repeat(np.arange(len(centers)), pieces)
    layout = spark.createDataFrame(
        [(c, int(first_piece[c]), int(pieces[c]), int(first_block[c]), int(asking[c])) for c in np.flatnonzero(pieces).tolist()],
        "cell int, first_piece long, pieces long, first_block long, blocks long",
    )
    spread = placed.join(F.broadcast(layout), "cell")  # a row a cell
    piece = (F.col("first_piece") + F.pmod(digest, F.col("pieces"))).alias("piece")
    block = (F.col("first_block") + F.pmod(digest, F.col("blocks"))).alias("qb")
    index = settle(coded(packed(spread.select("id", "v", piece), "piece"), centers, cell_of_piece, seed))
    blocks = settle(packed(spread.where("asks").select("id", "v", block).dropDuplicates(["id", "v"]), "qb"))

    salts = max(1, -(-int(first_block[-1]) // QUERY_BLOCKS))
    salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    tasks = int(min(100_000, 2 * salts * first_piece[-1]))
    common_args = (tasks, centers, cell_of_piece, k, seed)
    at_home = settle(meet(salted, visits(blocks, centers, radius, first_piece, salts, home=True), *common_args))
    barred = settle(with_bars(blocks, at_home, k))
    found = at_home.unionByName(meet(salted, visits(barred, centers, radius, first_piece, salts, home=False), *common_args))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
