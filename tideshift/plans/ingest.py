"""From landed sources to checked measurements, and from measurements to regime models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.operators.gaps import forward_fill
from tideshift.operators.joins import exact_join, nearest_join
from tideshift.operators.runs import MAX_ROWS
from tideshift.operators.validation import check_ranges, missing_columns, stamp_batch
from tideshift.session import settle
from tideshift.sources.lake import quarantine_records, write_lake
from tideshift.sources.payloads import normalize


class RejectedBatch(ValueError):
    """A batch without the required columns; the caller quarantines it whole."""


def join_measurements(
    energy: DataFrame | None,
    prices: DataFrame | None,
    weather: DataFrame | None = None,
    nearest: bool = True,
    tolerance_minutes: float = 60,
    fill_limit: int = 2,
    keys: Sequence[str] = (),
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Production with the nearest price and the weather of the same time, short gaps filled.

    Any of the sources may be absent, but not all.
    """
    if energy is not None and prices is not None:
        if nearest:
            merged = nearest_join(energy, prices, tolerance_minutes, keys, max_rows=max_rows)
        else:
            merged = exact_join(energy, prices, keys)
    else:
        merged = energy if energy is not None else prices
    if weather is not None:
        merged = weather if merged is None else exact_join(merged, weather, keys, how="left")
    if merged is None:
        raise RejectedBatch("no source returned data")
    return forward_fill(merged, fill_limit, keys=keys, max_rows=max_rows)


def ingest_batch(
    energy: DataFrame | None,
    prices: DataFrame | None,
    weather: DataFrame | None = None,
    source: str = "landed",
    keys: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Raw source rows to stamped measurements, with a ``reason`` on those to quarantine."""
    frames = [None if f is None else normalize(f, keys=keys) for f in (energy, prices, weather)]
    joined = join_measurements(*frames, keys=keys, **options)
    missing = missing_columns(joined)
    if missing:
        raise RejectedBatch(f"missing columns {missing}")
    return stamp_batch(check_ranges(joined, ts="timestamp"), source)


def store_batch(
    checked: DataFrame,
    lake: str,
    quarantine: str,
    start: datetime | None = None,
    end: datetime | None = None,
    unusable: DataFrame | None = None,
    mode: str = "append",
) -> None:
    """Accepted rows to the lake, the others to quarantine. The batch is computed once for both.

    ``unusable`` payloads, which gave no rows, go to quarantine as they are.
    """
    stored = settle(checked)
    write_lake(stored.where(F.col("reason").isNull()).drop("reason"), lake, mode=mode)
    bad = quarantine_records(stored.where(F.col("reason").isNotNull()), start, end)
    if unusable is not None:
        bad = bad.unionByName(quarantine_records(unusable.withColumn("reason", F.lit("unusable payload")), start, end))
    bad.write.mode(mode).partitionBy("reason").json(quarantine)
