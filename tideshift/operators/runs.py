"""Ordered work on series of any size.

A window partitioned by series puts each series into one task. That is the cheapest plan while every
series fits a task, and it fails once one series holds a large share of the data. ``ordered_runs``
counts the rows per series first. Series within ``max_rows`` stay whole (run 0, one exchange). Larger
ones are range-partitioned by their order, and the rows of a partition are cut into runs of ``max_rows``
rows. The number of tasks and files follows the rows, not the runs. What a run needs from its neighbours
travels separately and stays small: trailing rows (``with_halo``), last known values (``carry``) and sums
(``cumulative``, ``numbered``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideshift.session import settle

MAX_ROWS = 2_000_000
TASK_ROWS = 250_000  # rows of a range partition where runs are shorter
MAX_PARTS = 20_000  # one shuffle stays manageable; beyond it partitions grow instead, and sorting spills
MAX_HEAVY = 10_000
RUN = "__run"
HALO = "__halo"


def same_keys(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality over ``names`` in which missing keys match each other."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names], F.lit(True))


def join_keys(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on ``names`` with missing keys matching, keeping the names of the left side once."""
    renamed = right.select(
        *[F.col(n).alias(f"__r_{n}") for n in names],
        *[F.col(c) for c in right.columns if c not in names],
    )
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__r_{n}")) for n in names], F.lit(True))
    return left.join(renamed, on, how).drop(*[f"__r_{n}" for n in names])


def heavy_series(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame | None:
    """Series above ``max_rows`` as a small table, or None if there is none."""
    spark = df.sparkSession
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows)
    found = sizes.limit(MAX_HEAVY + 1).collect()
    if not found:
        return None
    if len(found) > MAX_HEAVY:
        # Too many to ship to every task; the caller then lays out all series by range.
        total = sizes.agg(F.sum("__n").alias("__n")).collect()[0]["__n"]
        return spark.range(1).select(F.lit(total).alias("__n"), F.lit(True).alias("__all"))
    return spark.createDataFrame(found, sizes.schema)


@dataclass(frozen=True)
class OrderedRuns:
    """Rows with a run number; ``split`` says whether any series has more than one run."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    stored: DataFrame | None = None
    group: list[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "group", [*self.keys, RUN])

    def replace(self, df: DataFrame, same_rows: bool = True) -> "OrderedRuns":
        """The same layout with other columns, or with other rows if said so."""
        return OrderedRuns(df, self.keys, self.order, self.split, self.stored if same_rows else None)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*self.order)

    @property
    def backwards(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*[F.desc(c) for c in self.order])

    def _per_run(self, columns: Iterable[str], *aggs: Column) -> DataFrame:
        """One row per run. Columns of the stored runs are read from there, past all derived columns."""
        plain = self.stored is not None and set(columns) <= set(self.stored.columns)
        rows = self.stored if plain else self.df.where(F.col(RUN) > 0)
        return rows.groupBy(*self.group).agg(*aggs)

    def _runs_in_order(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(RUN)

    def with_halo(self, rows: int) -> "OrderedRuns":
        """Give each run the ``rows`` rows before its first one, marked by ``__halo``.

        Windows that look back at most ``rows`` rows are then right for every row that is not halo.
        """
        own = self.df.withColumn(HALO, F.lit(False))
        if not self.split or rows <= 0:
            return self.replace(own, same_rows=False)
        before = self._runs_in_order().rowsBetween(Window.unboundedPreceding, -1)
        after = self._runs_in_order().rowsBetween(1, rows)
        starts = self._per_run([], F.count(F.lit(1)).alias("__size")).withColumn(
            "__start", F.coalesce(F.sum("__size").over(before), F.lit(0))
        )
        # A later run needs a row if fewer than `rows` rows lie between the row and the run's start.
        targets = starts.withColumn("__later", F.collect_list(F.struct(RUN, "__start")).over(after))
        tail = (
            self.df.where(F.col(RUN) > 0)
            .withColumn("__back", F.row_number().over(self.backwards))
            .where(F.col("__back") <= rows)
        )
        placed = join_keys(tail, targets, self.group, "inner").withColumn(
            "__position", F.col("__start") + F.col("__size") - F.col("__back")
        )
        moved = (
            placed.withColumn("__target", F.explode("__later"))
            .where(F.col("__target.__start") - F.col("__position") <= rows)
            .withColumn(RUN, F.col(f"__target.{RUN}"))
            .withColumn(HALO, F.lit(True))
            .select(*own.columns)
        )
        return self.replace(own.unionByName(moved), same_rows=False)

    def carry(self, columns: dict[str, str], backward: bool = False) -> DataFrame:
        """Per run, the last known value of each column in the earlier (or later) runs of its series.

        ``columns`` maps a source column to the name of the carried one. Run 0 has no neighbours.
        """
        place = F.struct(*self.order)
        pick = F.min_by if backward else F.max_by
        ends = self._per_run(
            [*columns, *self.order],
            *[pick(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"__end_{i}") for i, c in enumerate(columns)]
        )
        if backward:
            seen = Window.partitionBy(*self.keys).orderBy(F.desc(RUN)).rowsBetween(Window.unboundedPreceding, -1)
        else:
            seen = self._runs_in_order().rowsBetween(Window.unboundedPreceding, -1)
        return ends.select(
            *self.group,
            *[F.last(f"__end_{i}", True).over(seen).alias(name) for i, name in enumerate(columns.values())],
        )

    def last_known(self, columns: dict[str, str], backward: bool = False, strict: bool = False) -> DataFrame:
        """Rows plus, per column, its last non-missing value up to the row (``strict``: before it).

        ``backward`` looks at the following rows instead of the preceding ones.
        """
        window = (self.backwards if backward else self.window).rowsBetween(
            Window.unboundedPreceding, -1 if strict else 0
        )
        seen = self.df.withColumns({name: F.last(c, True).over(window) for c, name in columns.items()})
        if not self.split:
            return seen
        carried = self.carry({c: f"__carried_{name}" for c, name in columns.items()}, backward)
        joined = join_keys(seen, carried, self.group, "left")
        return joined.withColumns(
            {name: F.coalesce(F.col(name), F.col(f"__carried_{name}")) for name in columns.values()}
        ).drop(*[f"__carried_{name}" for name in columns.values()])

    def whole(self, columns: dict[str, tuple[str, str]]) -> DataFrame:
        """Rows plus aggregates of their whole series; ``columns`` maps a name to (sum|min|max, column)."""
        everything = Window.partitionBy(*self.group)
        out = self.df.withColumns({n: getattr(F, f)(c).over(everything) for n, (f, c) in columns.items()})
        if not self.split:
            return out
        parts = self._per_run([c for _, c in columns.values()], *[getattr(F, f)(c).alias(f"__p_{n}") for n, (f, c) in columns.items()])
        series = Window.partitionBy(*self.keys)
        combined = parts.select(
            *self.group, *[getattr(F, f)(f"__p_{n}").over(series).alias(f"__w_{n}") for n, (f, _) in columns.items()]
        )
        joined = join_keys(out, combined, self.group, "left")
        return joined.withColumns({n: F.coalesce(f"__w_{n}", n) for n in columns}).drop(*[f"__w_{n}" for n in columns])

    def cumulative(self, columns: dict[str, str]) -> DataFrame:
        """Rows plus running sums of ``columns`` (source to name) over the whole series."""
        running = self.window.rowsBetween(Window.unboundedPreceding, 0)
        out = self.df.withColumns({name: F.sum(c).over(running) for c, name in columns.items()})
        if not self.split:
            return out
        sums = self._per_run(columns, *[F.sum(c).alias(f"__sum_{name}") for c, name in columns.items()])
        before = self._runs_in_order().rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select(
            *self.group, *[F.sum(f"__sum_{n}").over(before).alias(f"__off_{n}") for n in columns.values()]
        )
        joined = join_keys(out, offsets, self.group, "left")
        return joined.withColumns(
            {n: F.col(n) + F.coalesce(F.col(f"__off_{n}"), F.lit(0)) for n in columns.values()}
        ).drop(*[f"__off_{n}" for n in columns.values()])

    def numbered(self, name: str = "position", total: str | None = None) -> DataFrame:
        """Rows plus their 1-based place in the series and, on request, the series' row count."""
        counted = self.replace(self.df.withColumn("__one", F.lit(1).cast("long")))
        # The ordered window first: its sort then serves the unordered one too.
        counted = counted.replace(counted.cumulative({"__one": name}))
        out = counted.df if total is None else counted.whole({total: ("sum", "__one")})
        return out.drop("__one")


def ordered_runs(
    df: DataFrame,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("timestamp",),
    max_rows: int | None = MAX_ROWS,
) -> OrderedRuns:
    """Lay out ``df`` for ordered work per series.

    ``order`` should identify a row within its series; ties are ordered arbitrarily, as in any sort.
    ``max_rows=None`` skips the count where the size of every series is known to be bounded.
    """
    keys, order = tuple(keys), tuple(order)
    whole = df.withColumn(RUN, F.lit(0))
    heavy = heavy_series(df, keys, max_rows) if max_rows is not None else None
    if heavy is None:
        return OrderedRuns(whole, keys, order, split=False)
    everything = not keys or "__all" in heavy.columns
    rows = heavy.agg(F.sum("__n")).collect()[0][0]
    # Sampling the range bounds, dealing out and picking whole series each read the rows: they are derived once.
    df = settle(df)
    if everything:
        large, small = df, None
    else:
        listed = F.broadcast(heavy.drop("__n"))  # at most MAX_HEAVY rows
        large = join_keys(df, listed, keys, "left_semi")
        small = join_keys(df, listed, keys, "left_anti").withColumn(RUN, F.lit(0))
    parts = min(-(-rows // max(max_rows, TASK_ROWS)) + 1, MAX_PARTS)
    ranged = large.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    # Row ids rise along a partition and leap between partitions, so no run reaches over a border.
    ranged = ranged.withColumn(RUN, F.floor(F.monotonically_increasing_id() / max_rows) + 1)
    # Range bounds come from a sample, so the run numbers must be written down before reuse.
    runs = settle(ranged)
    return OrderedRuns(runs if small is None else runs.unionByName(small), keys, order, split=True, stored=runs)
