"""What the text operators share: reading tables, bounded Arrow batches, texts as byte arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Bytes of text that one step of a task works on; the arrays made from it are about 50 times as large.
SLICE_BYTES = 1 << 21
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that a run of very long texts never outgrows a Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) != str(BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte array and row offsets starting at 0; missing texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of text; a longer text stands alone."""
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def map_texts(
    df: DataFrame,
    work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: T.StructType,
    text: str = "text",
) -> DataFrame:
    """Run ``work()`` once per task and what it returns on each slice of the task's texts."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            step = step or work()
            for piece in slices(batch, text):
                yield step(piece)

    return df.mapInArrow(run, schema)


def with_fields(df: DataFrame, keep: Sequence[str], made: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    """Schema of the kept columns followed by the made ones; a made column replaces a kept one of its name."""
    names = {n for n, _ in made}
    kept = [df.schema[c] for c in keep if c not in names]
    return T.StructType([*kept, *[T.StructField(n, t) for n, t in made]])


def codepoints(data: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes."""
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def char_offsets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row offsets in code points, from row offsets in bytes."""
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return starts[offsets]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
