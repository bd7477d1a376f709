"""Joins on time, gap filling and ingest against pandas and brute force."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideshift.operators import gaps, joins, validation
from tideshift.plans.ingest import RejectedBatch, ingest_batch
from tideshift.sources import lake, payloads, synthetic

T0 = pd.Timestamp("2024-01-01")


def stamped(spark, minutes, **columns):
    frame = pd.DataFrame({"timestamp": [T0 + pd.Timedelta(minutes=int(m)) for m in minutes], **columns})
    return spark.createDataFrame(frame, ", ".join(["timestamp timestamp", *[f"{c} long" for c in columns]])).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 300), min_size=1, max_size=25), st.lists(st.integers(0, 300), min_size=1, max_size=25))
def test_nearest_join_matches_pandas(spark, left, right):
    left, right = sorted(left), sorted(right)
    a = stamped(spark, left, lid=range(len(left)))
    b = stamped(spark, right, rid=range(len(right)))
    got = joins.nearest_join(a, b, 60, tie=["rid"]).toPandas().sort_values("lid")["rid"]
    x, y = (d.toPandas().sort_values("timestamp", kind="stable") for d in (a, b))
    expected = pd.merge_asof(x, y, on="timestamp", direction="nearest", tolerance=pd.Timedelta(minutes=60)).sort_values("lid")["rid"]
    np.testing.assert_array_equal(got.to_numpy(dtype=float), expected.to_numpy(dtype=float))


def test_nearest_join_rules(spark):
    left = stamped(spark, [100, 200, 300], lid=[0, 1, 2]).unionByName(
        spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.lit(3).cast("long").alias("lid"))
    )
    right = stamped(spark, [90, 110, 140, 140, 361], rid=[0, 1, 2, 3, 4])
    got = dict(joins.nearest_join(left, right, 60, tie=["rid"]).select("lid", "rid").collect())
    # Tie goes backward; exactly 60 minutes is inside and the last of equal ones counts; 61 is outside; no time, no match.
    assert got == {0: 0, 1: 3, 2: None, 3: None}


def test_missing_timestamps_meet_on_request(spark):
    none = F.lit(None).cast("timestamp_ntz").alias("timestamp")
    a, b = spark.range(1).select(none, F.col("id").alias("x")), spark.range(1).select(none, F.col("id").alias("y"))
    assert joins.exact_join(a, b).count() == 0
    assert joins.exact_join(a, b, match_missing=True).count() == 1


@pytest.mark.parametrize("limit", [0, 1, 2, 5])
def test_forward_fill_matches_pandas(spark, limit):
    rng = np.random.default_rng(limit)
    values = pd.Series(np.where(rng.random(200) < 0.5, np.nan, np.arange(200)), dtype="float")
    df = spark.createDataFrame(pd.DataFrame({"timestamp": T0 + pd.to_timedelta(np.arange(200), unit="h"), "price": values}))
    df = df.withColumn("price", F.nanvl("price", F.lit(None)))
    got = gaps.forward_fill(df, limit).toPandas().sort_values("timestamp")["price"].to_numpy(dtype=float)
    np.testing.assert_array_equal(got, (values.ffill(limit=limit) if limit else values).to_numpy())


def test_spine_is_cut_and_complete(spark, monkeypatch):
    monkeypatch.setattr(gaps, "STEPS_PER_ROW", 7)
    ends = stamped(spark, [0, 60 * 100], x=[1, 2])
    hours = gaps.spine(ends).toPandas()["timestamp"].sort_values().tolist()
    assert hours == list(pd.date_range(T0, periods=101, freq="h"))


def test_synthetic_series(spark):
    day = synthetic.synthetic_series(spark, datetime(2026, 1, 1), datetime(2026, 1, 2)).toPandas()
    assert len(day) == 25 and list(day.columns) == list(validation.REQUIRED)
    week = synthetic.synthetic_series(spark, datetime(2026, 1, 1), datetime(2026, 3, 1)).toPandas()
    assert week["wind_speed"].between(0, 20).all() and week["energy_production"].between(0, 1000).all()
    assert week["temperature"].between(-40, 50).all() and week["price"].between(50, 500).all()
    assert week["wind_speed"].corr(week["energy_production"]) > 0.3 and week["wind_speed"].corr(week["price"]) < -0.1
    assert week["timestamp"].diff().dropna().eq(pd.Timedelta(hours=1)).all()


def test_validation(spark):
    good = synthetic.synthetic_series(spark, datetime(2026, 1, 1), datetime(2026, 1, 1, 9))
    assert validation.validate_batch(good)[0]
    assert validation.missing_columns(good.select("timestamp")) == ["wind_speed", "energy_production", "temperature", "price"]
    assert not validation.validate_batch(good.select("timestamp"))[0]
    empty = good.withColumn("wind_speed", F.lit(None).cast("double"))
    passed, report = validation.validate_batch(empty)
    assert passed and [r["column_name"] for r in report.where("above_threshold").collect()] == ["wind_speed"]
    assert not validation.validate_batch(empty, fail_on_nulls=True)[0]
    twice = good.unionByName(good.limit(3)).unionByName(good.limit(2).withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    assert validation.duplicate_timestamps(twice).first()["n_duplicates"] == 4
    stamped_rows = validation.stamp_batch(good, "made")
    assert {"ingestion_timestamp", "data_source"} <= set(stamped_rows.columns)


def test_unusable_sources_are_rejected(spark):
    rows = spark.createDataFrame([("a", 1.0)], "when string, price double")
    with pytest.raises(payloads.UnusablePayload):
        payloads.resolve_timestamp(rows)
    with pytest.raises(RejectedBatch):
        ingest_batch(None, None)
    prices = spark.createDataFrame([("2024-01-01", 1.0)], "HourUTC string, Price double")
    with pytest.raises(RejectedBatch):
        ingest_batch(None, prices)


def test_category_with_production_in_its_name_is_no_measure(spark):
    rows = spark.createDataFrame([("solar", 2.0)], "ProductionType string, grossProduction double")
    assert payloads.name_production(rows).columns == ["ProductionType", "energy_production"]


def test_lake_prunes_days_and_reads_rows_once(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = synthetic.synthetic_series(spark, datetime(2026, 1, 1), datetime(2026, 1, 5)).withColumn("ingestion_timestamp", F.lit(1))
    lake.write_lake(rows, path)
    lake.write_lake(rows.withColumns({"ingestion_timestamp": F.lit(2), "price": F.lit(9.0)}), path)
    part = lake.read_lake(spark, path, datetime(2026, 1, 2, 6), datetime(2026, 1, 3))
    assert "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString()
    once = lake.latest_ingested(part, [])
    assert once.count() == 19 and [r[0] for r in once.select("price").distinct().collect()] == [9.0]
    stamped_path = str(tmp_path / "run")
    lake.write_lake(rows, stamped_path, run_end=datetime(2026, 1, 5))
    assert [tuple(r) for r in spark.read.parquet(stamped_path).select("year", "month", "day").distinct().collect()] == [(2026, 1, 5)]
