"""Connected components of an edge table, by contraction.

Every round each vertex moves to the neighbour (or itself) that comes first in a fresh random order, which
removes a constant share of the vertices whatever the shape of the graph; hubs cost one aggregated row per
task. Rounds are written to the shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.session import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex`` and ``root`` for every vertex of an edge; vertices of one component share a root.

    Edges with a missing end are left out; loops and repeated edges change nothing.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    vertices = pairs.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    current = settle(pairs.where("a <> b").distinct())
    labels = settle(vertices.select("vertex", F.col("vertex").alias("root")))
    turn = 0
    while current.limit(1).count():
        turn += 1
        order = F.xxhash64(F.col("to"), F.lit(turn))
        both = current.select(F.explode(F.array(
            F.struct(F.col("a").alias("at"), F.col("b").alias("to")), F.struct(F.col("b").alias("at"), F.col("a").alias("to")),
            F.struct(F.col("a").alias("at"), F.col("a").alias("to")), F.struct(F.col("b").alias("at"), F.col("b").alias("to")),
        )).alias("e")).select("e.*")
        moves = settle(
            both.groupBy("at").agg(F.min(F.struct(order.alias("o"), "to")).alias("m")).select("at", F.col("m.to").alias("to"))
        )
        first = current.join(moves, F.col("a") == F.col("at")).select(F.col("to").alias("a"), "b")
        second = first.join(moves, F.col("b") == F.col("at")).select("a", F.col("to").alias("b"))
        current = settle(
            second.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
        labels = settle(
            labels.join(moves, F.col("root") == F.col("at"), "left").select("vertex", F.coalesce("to", "root").alias("root"))
        )
    return labels if turn else spark.createDataFrame([], labels.schema).union(labels)
