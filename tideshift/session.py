"""Session settings, shared scratch space and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "tideshift",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with the settings the operators rely on: UTC, ANSI and adaptive execution.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset; adaptive execution merges small
    shuffle partitions, so the cluster-wide default only has to be large enough.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The JVM interprets methods above 8000 bytes of code. Wide feature tables would hit that, so such
        # stages run with split projections instead of one fused method.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:  # a local session runs its tasks in the driver
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it gets a fresh temporary folder once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tideshift-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` below the shared folder once and go on from the stored table.

    ``by`` lays the table out in folders, so that a filter on these columns reads only its part.

    Needed wherever rows carry a value that a recomputation could change (the number of the range
    partition a row fell into) and between the rounds of an iterative fit. Being columnar, the table is
    read back with only the columns each consumer needs. The folder's owner clears it after the session.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle width, for steps with little data but much work per row: an explicit number
    keeps adaptive execution from merging their partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
