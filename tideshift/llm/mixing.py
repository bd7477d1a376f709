"""Mixing sources to target weights by Pfair scheduling, with built-in DataFrame and SQL functions only.

Each source's rows, in a random but repeatable order, are cut into blocks of ``block_rows``. Weights are rounded to
shares of a period of slots. Block k of a source with share s in a period of P slots is released at floor((k - 1) P / s)
and due at ceil(k P / s); in every slot the released block that is due first runs. With unit blocks and shares that
sum to the period, that order meets every deadline, so before every slot each source is less than one block away
from its weight. The order repeats with the period, so one period is scheduled and all blocks take their slots from it.

Sources are hashed into bundles of about ``BUNDLE_SOURCES`` or, if that is more, of about the square root of their number.
Bundles are scheduled against each other by the sum of their weights, and the sources of each bundle on the slots it
gets, one row for each bundle, by the same method. With one bundle a source is less than one block away from its weight,
with more it is less than one block away within its bundle, which itself is less than one away.

Nothing is dropped or repeated: when a source runs out its slots stay empty, and the others go on at their weights
relative to each other. Up to the last full block of the source that runs out first, the mix has the target weights.

Rows are numbered within 4,096 parts of each source, by leading bits of a digest of the row, and the parts' sizes are
added up, so no task holds a whole source. A missing source is a source of its own. Rows that repeat stay, side by side.
Columns of the table keep their values whatever their names, but for those that ``mix`` adds. Equal remainders go to the
first names, equal deadlines to the first source, an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideshift.session import settle

BLOCK_ROWS = 64
PERIOD = 1000
BUNDLE_SOURCES = 200
MAX_PLAN_ROWS = 500_000  # of a schedule that is broadcast; a larger one is joined by a shuffle
WEIGHT_SCALE = 1 << 40  # weights become integers up to this, so that their sums do not depend on the order
PART_BITS = 12
NO_SOURCE = "\x00missing"


def _rounded(weighted: DataFrame, by: Sequence[str], name: str, period: int) -> DataFrame:
    """``weighted`` with ``share`` and ``period``: integer shares of the period of each group, by the integer weights ``w``.

    Everyone has one slot at least, the other slots go by weight, and what rounding leaves goes to the largest remainders.
    """
    group = Window.partitionBy(*(by or [F.lit(0)]))  # a row for each source of a bundle, or for each bundle
    counted = weighted.withColumn("k", F.count(F.lit(1)).over(group)).withColumn("total", F.sum("w").over(group))
    counted = counted.withColumn("period", F.greatest(F.lit(period).cast("long"), 10 * F.col("k")))
    counted = counted.withColumn("exact", F.col("w") / F.col("total") * (F.col("period") - F.col("k")))
    counted = counted.withColumn("whole", F.floor("exact"))
    left = F.col("period") - F.col("k") - F.sum("whole").over(group)
    turn = F.row_number().over(group.orderBy((F.col("whole") - F.col("exact")).asc(), name))
    shared = counted.withColumn("share", F.col("whole") + 1 + (turn <= left).cast("long"))
    return shared.drop("k", "total", "exact", "whole", "w")


def source_shares(
    df: DataFrame, source: str = "source", weights: Mapping[str | None, float] | None = None, power: float = 0.5, period: int = PERIOD
) -> DataFrame:
    """``source`` (missing as ``NO_SOURCE``), its ``share`` of its bundle's ``period``, its ``rows``, its ``bundle``, and the
    ``bundle_share`` of the ``bundle_period``.

    Given weights hold for the sources they name, others get the smallest of them; without weights a source's
    weight is the given power of its number of rows, so that large sources give way to small ones. A period grows to ten
    times the number of those that share it if it is shorter.
    """
    sizes = df.groupBy(F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weight = F.pow(F.col("rows").cast("double"), F.lit(power))
    else:
        if not weights or min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (NO_SOURCE if k is None else k, float(w))])
        weight = F.coalesce(F.try_element_at(named, F.col("source")), F.lit(float(min(weights.values()))))
    sizes = settle(sizes.select("source", "rows", weight.alias("weight")))
    k, most = sizes.agg(F.count(F.lit(1)), F.max("weight")).collect()[0]
    bundles = max(1, -(-k // max(BUNDLE_SOURCES, math.isqrt(k))))
    whole = F.greatest(F.lit(1), F.round(F.col("weight") / F.lit(most or 1.0) * WEIGHT_SCALE)).cast("long")
    weighted = sizes.select("source", "rows", whole.alias("w"), F.pmod(F.xxhash64("source"), F.lit(bundles)).cast("long").alias("bundle"))
    tops = _rounded(weighted.groupBy("bundle").agg(F.sum("w").alias("w")), [], "bundle", period)
    tops = tops.select("bundle", F.col("share").alias("bundle_share"), F.col("period").alias("bundle_period"))
    inner = _rounded(weighted, ["bundle"], "source", period)
    return inner.join(tops, "bundle").select("source", "share", "rows", "period", "bundle", "bundle_share", "bundle_period")


def schedule(shares: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``source``, ``k`` (its block within the period, from 1), ``at`` (the slot), ``share`` and ``period``, for each group."""
    listed = shares.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("source", "share"))).alias("s"), F.max("period").cast("int").alias("p")
    )
    due = "cast(ceil(acc.next[i] * p / s[i].share) as bigint)"
    released = "(acc.next[i] - 1) * p div s[i].share <= t"
    # Of the released blocks the one due first, the first source on a tie; block k of a source is k-th in the period.
    pick = (
        "array_min(transform(filter(sequence(0, size(s) - 1), i -> acc.next[i] <= s[i].share and " + released + "),"
        " i -> named_struct('due', " + due + ", 'i', i))).i"
    )
    run = (
        "aggregate(sequence(0, p - 1), named_struct('next', transform(s, x -> 1L), 'slots', cast(array() as array<int>)),"
        " (acc, t) -> element_at(transform(array(" + pick + "), j -> named_struct("
        "'next', transform(acc.next, (n, i) -> if(i = j, n + 1, n)), 'slots', array_append(acc.slots, j))), 1),"
        " acc -> acc.slots)"
    )
    slots = listed.where("size(s) > 0").select(*by, "s", "p", F.posexplode(F.expr(run)).alias("at", "j"))
    named = slots.select(*by, F.expr("s[j].source").alias("source"), F.expr("s[j].share").alias("share"), "at", F.col("p").alias("period"))
    order = Window.partitionBy(*by, "source").orderBy("at")
    return named.withColumn("k", F.row_number().over(order))


def _plan(shares: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The slots of each source within its bundle (``source``, ``k``, ``at``) and those of each bundle (``bundle``, ``top_k``,
    ``top_at``), to be broadcast where they are few."""
    inner = settle(schedule(shares, ["bundle"]).select("source", "k", "at"))
    tops = shares.select(F.col("bundle").alias("source"), F.col("bundle_share").alias("share"), F.col("bundle_period").alias("period"))
    outer = settle(schedule(tops.distinct()).select(F.col("source").alias("bundle"), F.col("k").alias("top_k"), F.col("at").alias("top_at")))
    return tuple(F.broadcast(x) if x.count() <= MAX_PLAN_ROWS else x for x in (inner, outer))


def mix(
    df: DataFrame,
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    power: float = 0.5,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    seed: int = 17,
) -> DataFrame:
    """``df`` with ``mix_slot`` (the slot of the row's block), ``mix_block`` (the block's number within its source,
    from 0) and ``mix_position`` (the row's place in the mix; places of missing slots stay empty).

    Columns of these names in ``df`` are replaced; all others stay.
    """
    shares = settle(source_shares(df, source, weights, power, period))
    inner, outer = _plan(shares)
    own = [c for c in df.columns if c not in ("mix_slot", "mix_block", "mix_position")]
    values = [F.col(f"`{c}`") for c in own]
    name = F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE))
    rows = df.select(F.struct(*values).alias("row"), name.alias("source"), F.xxhash64(F.lit(seed), *values).alias("draw"))
    rows = rows.withColumn("part", F.shiftrightunsigned("draw", 64 - PART_BITS).cast("int"))
    sizes = rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).join(shares.drop("rows"), "source")
    within = Window.partitionBy("source", "part").orderBy("draw", *[F.col("row")[c] for c in own if _sortable(df, c)])
    numbered = rows.withColumn("nth", F.row_number().over(within)).join(starts, ["source", "part"])
    rank = F.col("start") + F.col("nth") - 1
    placed = numbered.withColumn("block", F.floor(rank / block_rows).cast("long")).withColumn("rest", rank % block_rows)
    placed = placed.withColumn("k", F.col("block") % F.col("share") + 1).join(inner, ["source", "k"])
    # The how-manieth slot of its bundle, and that slot among all.
    placed = placed.withColumn("turn", F.expr("(block div share) * period + at"))
    placed = placed.withColumn("top_k", F.col("turn") % F.col("bundle_share") + 1).join(outer, ["bundle", "top_k"])
    slot = F.expr("(turn div bundle_share) * bundle_period + top_at")
    added = [slot.alias("mix_slot"), F.col("block").alias("mix_block"), (slot * block_rows + F.col("rest")).alias("mix_position")]
    return placed.select("row.*", *added)


def _sortable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def in_order(mixed: DataFrame, shares: DataFrame, partitions: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows laid out by ``mix_position``: partition after partition, and in order within each.

    ``shares`` (from ``source_shares``) give the last slot, so no row is read to find the borders of the partitions.
    """
    blocks = F.ceil(F.col("rows") / block_rows)
    turns = (F.floor((blocks - 1) / F.col("share")) + 1) * F.col("period")
    last = shares.agg(F.max((F.floor((turns - 1) / F.col("bundle_share")) + 1) * F.col("bundle_period"))).collect()[0][0] or 1
    width = -(-int(last) * block_rows // partitions)
    part = F.least(F.floor(F.col("mix_position") / width), F.lit(partitions - 1)).cast("int")
    return mixed.repartitionById(partitions, part).sortWithinPartitions("mix_position")
