"""Series cut into runs give the same results as whole series."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideshift.operators import changepoints, drift, features, gaps, joins, regimes, summaries
from tideshift.operators.runs import RUN, ordered_runs

MEASURES = list(features.MEASURES)


@pytest.fixture(scope="module")
def skewed(spark):
    """One series with most rows, some small ones, one row alone; gaps, zeros and a long gap."""
    rng = np.random.default_rng(3)
    frames = []
    for series, n in ((1, 400), (2, 30), (3, 30), (4, 1)):
        frame = pd.DataFrame(
            {c: np.where(rng.random(n) < 0.15, np.nan, rng.integers(0, 9, n) / 4.0) for c in MEASURES}
        )
        frame["timestamp"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="h")
        frame["series"] = series
        frames.append(frame)
    data = pd.concat(frames, ignore_index=True)
    data.loc[100:190, "price"] = np.nan
    df = spark.createDataFrame(data)
    return df.select("series", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *[F.nanvl(c, F.lit(None)).alias(c) for c in MEASURES])


def same(a, b, by):
    x = a.toPandas().sort_values(by).reset_index(drop=True)
    y = b.toPandas().sort_values(by).reset_index(drop=True)[x.columns]
    pd.testing.assert_frame_equal(x, y, check_exact=False, rtol=1e-9, atol=1e-9, check_dtype=False)


@pytest.mark.parametrize("max_rows", [7, 60])
def test_features(skewed, max_rows):
    kwargs = {"keys": ["series"], "dropna": False}
    same(features.engineer_features(skewed, **kwargs), features.engineer_features(skewed, max_rows=max_rows, **kwargs), ["series", "timestamp"])


def test_runs_are_small_and_only_where_needed(skewed):
    runs = ordered_runs(skewed, ["series"], ["timestamp"], max_rows=50)
    sizes = runs.df.groupBy("series", RUN).count().toPandas()
    assert set(sizes[sizes.series > 1][RUN]) == {0}
    big = sizes[sizes.series == 1]
    assert 0 not in set(big[RUN]) and len(big) >= 6 and big["count"].sum() == 400 and big["count"].max() <= 150


def test_missing_key_is_a_series(spark):
    df = spark.createDataFrame([(None, i) for i in range(40)] + [(1, i) for i in range(3)], "k int, t int")
    numbered = ordered_runs(df, ["k"], ["t"], max_rows=5).numbered("n", total="all").toPandas()
    assert len(numbered) == 43
    missing = numbered[numbered.k.isna()]
    assert (missing.n == missing.t + 1).all() and set(missing["all"]) == {40}


@pytest.mark.parametrize("max_rows", [5, 33])
def test_unkeyed_positions(skewed, max_rows):
    rows = skewed.where("series = 1")
    numbered = ordered_runs(rows, (), ["timestamp"], max_rows=max_rows).numbered("n").toPandas().sort_values("timestamp")
    assert numbered["n"].tolist() == list(range(1, 401))


def test_forward_fill(skewed):
    same(gaps.forward_fill(skewed, keys=["series"]), gaps.forward_fill(skewed, keys=["series"], max_rows=9), ["series", "timestamp"])


def test_nearest_join(skewed):
    left = skewed.select("series", "timestamp", "price")
    right = skewed.where("wind_speed > 1").select(
        "series", (F.col("timestamp") + F.expr("INTERVAL 20 MINUTES")).alias("timestamp"), F.col("wind_speed").alias("w")
    )
    same(joins.nearest_join(left, right, 90, ["series"]), joins.nearest_join(left, right, 90, ["series"], max_rows=11), ["series", "timestamp"])


def test_percentiles_and_drift(skewed):
    same(
        summaries.exact_percentiles(skewed, MEASURES, by=["series"]),
        summaries.exact_percentiles(skewed, MEASURES, by=["series"], max_rows=3),
        ["series", "column_name"],
    )
    a, b = skewed.where("hour(timestamp) < 9"), skewed.where("hour(timestamp) >= 9")
    same(drift.distances(a, b, MEASURES), drift.distances(a, b, MEASURES, max_rows=3), ["feature"])


def test_segments_and_transitions(spark, skewed):
    filled = skewed.fillna(0.0)
    ends = spark.createDataFrame([(1, e) for e in (50, 51, 300, 400)] + [(2, 10), (2, 30)], "series int, segment_end int")
    a = regimes.label_segments(filled, ends, "price", keys=["series"])
    b = regimes.label_segments(filled, ends, "price", keys=["series"], max_rows=13)
    same(a, b, ["series", "timestamp"])
    ruled = regimes.rule_regime(filled.withColumn("wind_speed", F.col("wind_speed") * 8))
    same(regimes.transitions(ruled, keys=["series"]), regimes.transitions(ruled, keys=["series"], max_rows=13), ["series", "timestamp"])


def test_change_points_of_cut_series(skewed):
    filled = skewed.fillna(0.0)
    same(
        changepoints.change_points(filled, "price", ["series"]),
        changepoints.change_points(filled.repartition(7), "price", ["series"]),
        ["series", "segment_end"],
    )


def test_short_runs_need_few_files(skewed):
    """Runs may be far shorter than what a task takes; tasks and files follow the rows."""
    runs = ordered_runs(skewed, ["series"], ["timestamp"], max_rows=7)
    assert len(runs.stored.inputFiles()) <= 2
    sizes = runs.stored.groupBy("series", RUN).count().toPandas()
    assert sizes["count"].max() <= 7 and sizes["count"].sum() == 460
    bounds = runs.stored.groupBy("series", RUN).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).toPandas()
    for _, own in bounds.sort_values(["series", RUN]).groupby("series"):
        assert (own["a"].iloc[1:].to_numpy() > own["b"].iloc[:-1].to_numpy()).all()
