"""Streaming ingest, scoring, rates and drift checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tideshift.operators import drift
from tideshift.operators.scoring import score_batch
from tideshift.operators.validation import check_ranges, stamp_batch
from tideshift.plans.ingest import store_batch
from tideshift.session import settle
from tideshift.sources.payloads import explode_records, normalize, rejected_payloads

CHECK_EVERY = "300 seconds"


def _start(writer, once: bool, every: str | None = None) -> StreamingQuery:
    """``once`` takes what is there and stops; else the stream runs, on a fixed pace if given."""
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def ingest_stream(
    spark: SparkSession,
    landing: str,
    record: T.StructType,
    lake: str,
    quarantine: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    one_per_file: bool = True,
    once: bool = True,
) -> StreamingQuery:
    """Landed payloads, one per file or one per line, to the lake; rejected rows to quarantine.

    Every micro-batch goes through the same operators as a batch run. Payloads that are no records go to quarantine
    with a reason. A micro-batch writes below its own ``batch=`` folder, so a batch repeated after a failure
    replaces its rows in both places.
    """
    files = spark.readStream.format("text").option("wholetext", str(one_per_file).lower()).load(landing)

    def store(batch: DataFrame, number: int) -> None:
        landed = settle(batch.withColumnRenamed("value", "payload"))
        rows = normalize(explode_records(landed, record), keys=keys)
        checked = stamp_batch(check_ranges(rows, ts="timestamp"), "stream")
        store_batch(
            checked, f"{lake}/batch={number}", f"{quarantine}/batch={number}",
            unusable=rejected_payloads(landed, record), mode="overwrite",
        )

    writer = files.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, once)


def score_stream(rows: DataFrame, path: str, checkpoint: str, score: Callable = score_batch, once: bool = True) -> StreamingQuery:
    """Score arriving requests; stateless, so a batch run over the same rows gives the same result."""
    writer = score(rows).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer.outputMode("append"), once)


def rate_stream(
    log: DataFrame,
    labels: Sequence[str],
    path: str,
    checkpoint: str,
    ts: str = "timestamp",
    window: str = "5 minutes",
    slide: str = "1 minute",
    late: str = "10 minutes",
    once: bool = True,
) -> StreamingQuery:
    """Events per second over sliding windows.

    Rows later than ``late`` behind the newest are dropped. Updated windows are written per batch, so a
    repeated batch replaces itself; ``read_rates`` returns the newest state of each.
    """
    length = log.sparkSession.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL '{window}') / 1e6D").collect()[0][0]
    counts = (
        log.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late)
        .groupBy(*labels, F.window(ts, window, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rates = counts.select(*labels, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), (F.col("n") / F.lit(float(length))).alias("rate"))

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rates.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, once)


def read_rates(spark: SparkSession, path: str, labels: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(path)
    newest = rows.groupBy(*labels, "window_start", "window_end").agg(F.max_by("rate", "batch").alias("rate"))
    return newest.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def drift_stream(
    log: DataFrame,
    reference_path: str,
    recent_path: str,
    report_path: str,
    checkpoint: str,
    order: Sequence[str] = ("timestamp",),
    columns: Sequence[str] = drift.WATCHED,
    current: int = drift.CURRENT_ROWS,
    once: bool = True,
    every: str = CHECK_EVERY,
    **options,
) -> StreamingQuery:
    """Check arriving rows for drift at a fixed pace, once a reference exists.

    Only the newest ``current`` rows are kept between checks, as a small table per batch; the check
    itself is the batch operator, and its rows are appended to the report.
    """
    def check(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        arrived = drift.current_rows(batch, list(order), rows=current)
        if number:
            earlier = spark.read.schema(batch.schema).parquet(f"{recent_path}/batch={number - 1}")
            arrived = drift.current_rows(earlier.unionByName(arrived), list(order), rows=current)
        kept = f"{recent_path}/batch={number}"
        arrived.write.mode("overwrite").parquet(kept)
        reference = _stored(spark, reference_path)
        now = spark.read.schema(batch.schema).parquet(kept)
        if reference is not None and now.count() >= current:
            report = drift.drift_report(reference, now, columns, **options)
            report.write.mode("overwrite").parquet(f"{report_path}/batch={number}")

    writer = log.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    return _start(writer, once, every)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None while there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
