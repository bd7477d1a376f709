"""Joining sources on time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.functions.values import micros
from tideshift.operators.runs import MAX_ROWS, join_keys, ordered_runs


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    tolerance_minutes: float = 60,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: Sequence[str] = (),
    right_ts: str | None = None,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Each left row with the right row nearest in time, at most ``tolerance_minutes`` away.

    Left rows without a match keep missing right columns. The tolerance is inclusive, a tie goes to the
    earlier right row, and of right rows with equal timestamps the last by ``tie`` counts. Left rows
    without timestamp never match.

    Both sides are laid out in one order, and each left row looks up the last right row before it and the
    first after it. No pairs are built, so neither a busy time span nor a busy key multiplies rows.
    """
    keys = list(keys)
    values = [c for c in right.columns if c not in (*keys, ts)]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    picked = F.struct(*values)
    # One right row per timestamp, collapsed before the shuffle where many rows share one.
    known = right.where(F.col(ts).isNotNull()).groupBy(*keys, ts)
    if len(tie) == 1:  # column by column, which a hash aggregate can hold
        last = known.agg(*[F.max_by(c, tie[0]).alias(c) for c in values])
        unique = last.select(*keys, ts, picked.alias("__values"))
    else:
        unique = known.agg((F.max_by(picked, F.struct(*tie)) if tie else F.max(picked)).alias("__values"))
    columns = F.struct(*left.columns)
    both = (
        left.select(*keys, ts, F.lit(1).alias("__side"), F.xxhash64(*left.columns).alias("__salt"), columns.alias("__left"))
        .unionByName(
            unique.select(
                *keys, ts, F.lit(0).alias("__side"), F.lit(0).cast("long").alias("__salt"),
                F.struct(F.col(ts).alias("at"), F.col("__values").alias("values")).alias("__right"),
            ),
            allowMissingColumns=True,
        )
    )
    runs = ordered_runs(both, keys, (ts, "__side", "__salt"), max_rows)
    runs = runs.replace(runs.last_known({"__right": "__before"}))
    runs = runs.replace(runs.last_known({"__right": "__after"}, backward=True))
    here = micros(F.col(ts))
    back = here - micros(F.col("__before.at"))
    ahead = micros(F.col("__after.at")) - here
    limit = int(tolerance_minutes * 60_000_000)
    use_before = (back <= limit) & (ahead.isNull() | (back <= ahead))
    chosen = F.when(use_before, F.col("__before")).when(ahead <= limit, F.col("__after"))
    matched = runs.df.where(F.col("__side") == 1).withColumn("__match", F.when(F.col(ts).isNotNull(), chosen))
    out = matched.select("__left.*", "__match")
    extra = [F.col("__match.at").alias(right_ts)] if right_ts else []
    return out.select(*left.columns, *extra, *[F.col("__match.values")[c].alias(c) for c in values])


def exact_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    how: str = "inner",
    match_missing: bool = False,
) -> DataFrame:
    """Equi-join on series and timestamp. ``match_missing`` lets rows without timestamp meet."""
    on = [*keys, ts]
    return join_keys(left, right, on, how) if match_missing else left.join(right, on, how)


def merge_sources(frames: Sequence[DataFrame], keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Full outer merge of any number of sources; of equally named columns the first known value counts."""
    on = [*keys, ts]

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        shared = [c for c in a.columns if c in b.columns and c not in on]
        other = b.withColumnsRenamed({c: f"__other_{c}" for c in shared})
        joined = a.join(other, on, "full_outer")
        return joined.withColumns({c: F.coalesce(c, f"__other_{c}") for c in shared}).drop(
            *[f"__other_{c}" for c in shared]
        )

    if not frames:
        raise ValueError("no source returned data")
    return reduce(merge, frames)
