"""Streams over the events table; each must agree with its batch counterpart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


from tideshift.operators.regimes import rule_regime
from tideshift.operators.scoring import fallback_prediction
from tideshift.plans import ingest_queries, monitoring_queries, regime_queries
from tideshift.plans.views import points, rounded, table, to_points
from tideshift.session import scratch_path
from tideshift.sources.logs import iso_text
from tideshift.streaming import streams


def event_stream(spark, sf) -> DataFrame:
    """The events table as a stream, be it one file or a folder of files: a source takes either as a pattern only."""
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")


def stream_score(spark, sf) -> DataFrame:
    home = scratch_path(spark, "scored")
    streams.score_stream(to_points(event_stream(spark, sf)), f"{home}/out", f"{home}/state").awaitTermination()
    columns = ("event_id", "status", "reason", "regime_id", "regime_name", "confidence", "prediction")
    return rounded(spark.read.parquet(f"{home}/out").select(*columns))


def stream_rate(spark, sf) -> DataFrame:
    home = scratch_path(spark, "rates")
    log = monitoring_queries.to_log(to_points(event_stream(spark, sf)))
    streams.rate_stream(log, ["status"], f"{home}/out", f"{home}/state").awaitTermination()
    return rounded(streams.read_rates(spark, f"{home}/out", ["status"]))


RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("TimeUTC", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in ingest_queries.MEASURES],
    ]
)


def stream_ingest(spark, sf) -> DataFrame:
    """Requests landed as one payload per line, streamed to lake and quarantine, and read back."""
    home = scratch_path(spark, "landing")
    record = F.struct(
        "event_id", iso_text(F.col("timestamp")).alias("TimeUTC"), *[F.col(c) for c in ingest_queries.MEASURES]
    )
    payload = F.to_json(F.struct(F.array(record).alias("records")))
    points(spark, sf).select(payload.alias("value")).write.text(f"{home}/in")
    streams.ingest_stream(
        spark, f"{home}/in", RECORD, f"{home}/lake", f"{home}/bad", f"{home}/state", keys=["event_id"], one_per_file=False
    ).awaitTermination()
    good = spark.read.parquet(f"{home}/lake").select("event_id", F.lit("lake").alias("went_to"))
    bad = spark.read.schema("record string, reason string").json(f"{home}/bad").select(
        F.from_json("record", "event_id long")["event_id"].alias("event_id"), F.col("reason").alias("went_to")
    )
    return good.unionByName(bad)


def stream_drift(spark, sf) -> DataFrame:
    """The newest requests of the stream against the stored first half of the period."""
    home = scratch_path(spark, "drift")
    scored = fallback_prediction(rule_regime(points(spark, sf)))
    scored.where(F.col("timestamp") < monitoring_queries.HALF).write.parquet(f"{home}/reference")
    arriving = fallback_prediction(rule_regime(to_points(event_stream(spark, sf))))
    streams.drift_stream(
        arriving, f"{home}/reference", f"{home}/recent", f"{home}/report", f"{home}/state", ["timestamp", "event_id"],
        checked_at=datetime(2024, 1, 31),
    ).awaitTermination()
    report = spark.read.parquet(f"{home}/report")
    return rounded(report.select("type", "feature", "severity", "ks_statistic", "wasserstein_distance", "kl_divergence", "chi2_statistic"))


QUERIES = {
    "stream_score": stream_score,
    "stream_rate": stream_rate,
    "stream_ingest": stream_ingest,
    "stream_drift": stream_drift,
}

ORACLE = {
    "stream_drift": monitoring_queries.ORACLE["stream_drift"],
    "stream_score": regime_queries.ORACLE["batch_score"],
    "stream_rate": monitoring_queries.ORACLE["rate_5m"],
    "stream_ingest": regime_queries.ORACLE["range_validate"].replace(
        f"{ingest_queries.REASON} AS reason", f"coalesce({ingest_queries.REASON}, 'lake') AS went_to"
    ),
}
