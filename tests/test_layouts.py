"""Layouts that once lost rows: lakes by run, missing keys, tables of several files, repeated batches, far values."""

from __future__ import annotations

import itertools
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.operators import drift, gaps, hmm, registry, summaries
from tideshift.plans import stream_queries
from tideshift.sources import lake
from tideshift.streaming import streams


def hours(spark, start, n):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=start + i), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, price double")


def test_lake_by_run_is_read_by_time(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(hours(spark, 0, 30), path, run_end=datetime(2024, 1, 2, 6))
    lake.write_lake(hours(spark, 10, 60), path, run_end=datetime(2024, 1, 4))
    assert lake.lake_reach(spark, path) == (3, 0)
    got = lake.read_lake(spark, path, datetime(2024, 1, 1), datetime(2024, 1, 1, 23))
    assert got.count() == 24 + 14 and got.select("timestamp").distinct().count() == 24
    assert lake.read_lake(spark, path, end=datetime(2023, 12, 31)).count() == 0
    own = str(tmp_path / "own")
    lake.write_lake(hours(spark, 0, 30), own)
    assert lake.lake_reach(spark, own) == (0, 0)
    assert lake.read_lake(spark, own, datetime(2024, 1, 2)).count() == 6


def test_missing_keys_are_series(spark):
    rows = [(None, datetime(2024, 1, d), float(d)) for d in (1, 2, 4)] + [("a", datetime(2024, 1, 1), 9.0)]
    df = spark.createDataFrame(rows, "k string, timestamp timestamp_ntz, price double")
    got = {(r[0], r[1].day): r[2] for r in gaps.on_spine(df, 86400, ["k"]).collect()}
    assert got == {(None, 1): 1.0, (None, 2): 2.0, (None, 3): None, (None, 4): 4.0, ("a", 1): 9.0}
    made = registry.assign_versions(spark.createDataFrame([(None, 1), ("a", 2)], "name string, registered_at int"))
    more = registry.assign_versions(spark.createDataFrame([(None, 3)], "name string, registered_at int"), made)
    assert more.collect()[0]["version"] == 2


def test_newest_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100_000).withColumn("k", F.col("id") % 3)
    plans = [summaries.recent_rows(df, n, ["id"], ["k"])._jdf.queryExecution().executedPlan().toString() for n in (1000, 5000)]
    assert [p.count("WindowGroupLimit") for p in plans] == [2, 2]


@pytest.mark.parametrize("block_rows", [4096, 2])
def test_far_values_keep_weights_finite(spark, block_rows):
    values = [0.1, 0.2, 100.0, 100.0]
    start, a = np.array([1.0, 0.0]), np.array([[1.0, 0.0], [0.0, 1.0]])
    mixed = np.array([[0.5, 0.5], [0.0, 1.0]])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "timestamp int, x double")
    for first, moves in ((start, a), (np.array([0.5, 0.5]), a), (start, mixed)):
        model = hmm.HmmModel(("x",), first, moves, np.array([[0.0], [100.0]]), np.array([[1.0], [1.0]]))
        blocks = hmm.pack(df, ["x"], block_rows=block_rows)
        terms = []
        with np.errstate(divide="ignore"):
            for path in itertools.product(range(2), repeat=4):
                steps = np.log(first[path[0]]) + sum(np.log(moves[i, j]) for i, j in zip(path, path[1:]))
                terms.append((steps + sum(-0.5 * ((v - 100 * k) ** 2 + np.log(2 * np.pi)) for v, k in zip(values, path)), path))
        top = max(t for t, _ in terms)
        total = top + np.log(sum(np.exp(t - top) for t, _ in terms))
        assert hmm.log_likelihood(blocks, model).collect()[0]["log_likelihood"] == pytest.approx(total)
        got = [r["regime_proba_1"] for r in hmm.posterior(blocks, model).orderBy("timestamp").collect()]
        want = [sum(np.exp(t - total) for t, p in terms if p[i] == 1) for i in range(4)]
        assert got == pytest.approx(want, abs=1e-9)
        again = hmm.fit(df, ["x"], n_regimes=2, start_from=model, n_iter=3, block_rows=block_rows)
        assert np.isfinite(again.log_likelihood)


def test_streams_read_tables_of_several_files(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    scored = stream_queries.stream_score(spark, str(tmp_path))
    assert scored.count() == events.count() == stream_queries.stream_score(spark, sf).count()


RECORD = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("TimeUTC", T.StringType()),
                       *[T.StructField(c, T.DoubleType()) for c in ("wind_speed", "energy_production", "temperature", "price")]])


def test_ingest_loses_and_repeats_nothing(spark, tmp_path):
    row = '{"event_id":%d,"TimeUTC":%s,"wind_speed":1.0,"energy_production":2.0,"temperature":3.0,"price":5.0}'
    good = '{"records":[' + row % (1, '"2024-01-01T00:00:00"') + "," + row % (2, "null") + "]}"
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.json").write_text(good + "\n" + '{"other":1}\nnot json\n')
    paths = [str(tmp_path / n) for n in ("lake", "bad")]
    for state in ("one", "two"):  # a new state replays the batch
        streams.ingest_stream(
            spark, str(landing), RECORD, *paths, str(tmp_path / state), keys=["event_id"], one_per_file=False
        ).awaitTermination()
    assert [r["event_id"] for r in spark.read.parquet(paths[0]).collect()] == [1]
    bad = spark.read.schema("record string, reason string").json(paths[1]).collect()
    assert sorted(r["reason"] for r in bad) == ["timestamp", "unusable payload", "unusable payload"]


def test_broken_references_are_not_taken_for_missing(spark, tmp_path):
    assert streams._stored(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        streams._stored(spark, str(tmp_path / "bad"))


def test_rates_drop_late_rows(spark, tmp_path):
    src = tmp_path / "log"
    at = lambda *minutes: spark.createDataFrame([(datetime(2024, 1, 1, 12) + timedelta(minutes=m), "ok") for m in minutes], "timestamp timestamp_ntz, status string")
    schema = at(0).schema
    for minutes in ((0, 1), (60,), (2, 59)):
        at(*minutes).coalesce(1).write.mode("append").parquet(str(src))
        log = spark.readStream.schema(schema).parquet(str(src))
        streams.rate_stream(log, ["status"], str(tmp_path / "out"), str(tmp_path / "state"), window="10 minutes", slide="10 minutes").awaitTermination()
    got = {r["window_start"].strftime("%H:%M"): round(r["rate"] * 600) for r in streams.read_rates(spark, str(tmp_path / "out"), ["status"]).collect()}
    assert got == {"12:00": 2, "12:50": 1, "13:00": 1}  # the row of 12:02 came too late


def test_missing_verdicts_stay_missing(spark):
    rows = [(True, True, None), (True, False, None), (False, False, False), (True, False, False), (None, None, None)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    got = [r[0] for r in df.select(drift.severity([F.col(c) for c in "abc"])).collect()]
    assert got == ["high", None, "low", "medium", None]


def test_reference_follows_clean_series(spark):
    rng = np.random.default_rng(0)
    rows = [(k, half, i, float(v)) for k, shift in (("still", 0.0), ("moved", 9.0)) for half in (0, 1) for i, v in enumerate(rng.normal(shift * half, 0.1, 300))]
    df = spark.createDataFrame(rows, "k string, half int, i int, price double")
    old, new = df.where("half = 0"), df.where("half = 1")
    report = drift.drift_report(old, new, ["price"], None, None, ["k"], thresholds=drift.Thresholds(ks_p=1e-9, kl=9.0))
    kept = drift.updated_reference(old, new, report, ["i"], ["k"], rows=120)
    assert {(r["k"], r["half"]): r["count"] for r in kept.groupBy("k", "half").count().collect()} == {("still", 1): 120, ("moved", 0): 300}
