"""Features against pandas, and the feature table's shape."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideshift.operators import features, scaling
from tideshift.sources import lake

MEASURES = list(features.MEASURES)


def series(n=100, seed=0, gaps=0.1):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({c: np.round(rng.uniform(0, 20, n), 1) for c in MEASURES})
    frame["wind_speed"] = np.where(rng.random(n) < 0.3, 0.0, frame["wind_speed"])
    frame = frame.mask(rng.random(frame.shape) < gaps)
    frame.insert(0, "timestamp", pd.Timestamp("2026-01-01") + pd.to_timedelta(np.arange(n), unit="h"))
    return frame


def to_spark(spark, frame):
    df = spark.createDataFrame(frame)
    return df.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *[F.nanvl(c, F.lit(None)).alias(c) for c in frame.columns[1:]])


@pytest.mark.parametrize("seed", range(3))
def test_values_match_pandas(spark, seed):
    frame = series(seed=seed)
    made = features.engineer_features(to_spark(spark, frame), dropna=False).toPandas().sort_values("timestamp").reset_index(drop=True)
    for c in MEASURES:
        x = frame[c]
        for w in (1, 6, 24):
            r = x.rolling(w, min_periods=1)
            expected = {f"{c}_ma_{w}h": r.mean(), f"{c}_std_{w}h": r.std(ddof=0), f"{c}_min_{w}h": r.min(), f"{c}_max_{w}h": r.max()}
            if w > 1:
                expected |= {f"{c}_cv_{w}h": r.std(ddof=0) / (r.mean() + 1e-6), f"{c}_range_{w}h": r.max() - r.min()}
            if w != 12:
                with pd.option_context("future.no_silent_downcasting", True):
                    filled = x.ffill()
                    expected[f"{c}_roc_{w}h"] = filled / filled.shift(w) - 1
            for name, values in expected.items():
                np.testing.assert_allclose(made[name].astype(float), values, rtol=1e-6, atol=1e-7, err_msg=name)
        for k in (1, 6, 12, 24):
            np.testing.assert_allclose(made[f"{c}_lag_{k}h"].astype(float), x.shift(k))
        for k in (1, 6):
            np.testing.assert_allclose(made[f"{c}_diff_{k}h"].astype(float), x.diff(k), atol=1e-9)
    assert made["day_of_week"].tolist() == frame["timestamp"].dt.dayofweek.tolist()
    assert made["is_weekend"].tolist() == (frame["timestamp"].dt.dayofweek >= 5).astype(int).tolist()


def test_shape(spark):
    df = to_spark(spark, series(gaps=0.0))
    table = features.engineer_features(df)
    assert len(table.columns) == 113
    assert len(features.engineer_features(df, rolling=[1, 6], volatility=[6]).columns) == 89
    # 24 rows lack a full history; a rate of 0 over 0 has no value either.
    assert 0 < table.count() <= 76
    chosen = features.feature_names(table.columns)
    assert len(chosen) == 111 and "energy_production_ma_1h" in chosen
    assert "energy_production_ma_1h" not in features.feature_names(table.columns, exclude_target_derived=True)


@pytest.mark.parametrize("seed", range(3))
def test_dropping_incomplete_rows_equals_dropping_on_the_finished_table(spark, seed):
    frame = series(n=150, seed=seed, gaps=0.01)
    frame.loc[60, "price"], frame.loc[90:120, "temperature"] = np.inf, -1e-6
    df = to_spark(spark, frame)
    a = features.engineer_features(df)
    b = features.engineer_features(df, dropna=False).dropna("any")
    kept = [r[0] for r in a.select("timestamp").orderBy("timestamp").collect()]
    assert kept == [r[0] for r in b.select("timestamp").orderBy("timestamp").collect()] and 0 < len(kept) < 120
    assert a.dropna("any").count() == len(kept)


def test_one_exchange_for_all_windows(spark):
    df = to_spark(spark, series()).withColumn("series", F.lit(1))
    plan = features.engineer_features(df, keys=["series"], dropna=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_division_by_zero(spark):
    frame = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=8, freq="h"), **{c: [1, np.nan, 0, 2, np.nan, np.nan, np.nan, 4] for c in MEASURES}})
    made = features.engineer_features(to_spark(spark, frame), dropna=False).orderBy("timestamp").toPandas()
    got = made["price_roc_1h"].tolist()
    assert np.isnan(got[0]) and got[1:] == [0.0, -1.0, np.inf, 0.0, 0.0, 0.0, 1.0]


def test_single_point_equals_a_series_of_one(spark):
    df = to_spark(spark, pd.DataFrame({"timestamp": [pd.Timestamp("2024-02-03 04:00")], "wind_speed": [8.5], "energy_production": [400.0], "temperature": [12.0], "price": [150.0]}))
    alone = features.single_point_features(df).toPandas()
    windowed = features.engineer_features(df, dropna=False).toPandas().fillna(0)[alone.columns]
    pd.testing.assert_frame_equal(alone, windowed, check_dtype=False)


def test_scalers(spark):
    df = to_spark(spark, series(gaps=0.0)).withColumn("temperature", F.lit(3.0))
    low, high = (
        scaling.apply_scaler(df, scaling.fit_scaler(df, ["wind_speed", "temperature"], "minmax"))
        .agg(F.struct(F.min("wind_speed"), F.max("wind_speed"), F.max("temperature")).alias("s"), F.lit(0))
        .first()
    )
    assert tuple(low) == (0.0, 1.0, 0.0)
    z = scaling.apply_scaler(df, scaling.fit_scaler(df, ["price", "temperature"], "zscore")).agg(
        F.avg("price"), F.stddev_pop("price"), F.max("temperature")
    ).first()
    assert abs(z[0]) < 1e-9 and abs(z[1] - 1) < 1e-9 and z[2] == 0.0


def test_feature_store(spark, tmp_path):
    from datetime import datetime

    store = str(tmp_path)
    a, b = spark.range(3).toDF("a"), spark.range(5).toDF("b")
    lake.save_features(a, store, "1.0.0", now=datetime(2024, 1, 1))
    lake.save_features(b, store, "2.0.0", now=datetime(2024, 1, 2))
    assert lake.load_features(spark, store).columns == ["b"]
    assert lake.load_features(spark, store, "1.0.0").count() == 3
    assert lake.load_features(spark, store, "9.9.9") is None


def one_series(spark, values):
    rows = [(0, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series int, timestamp int, x double")


def population_std(values, end, rows):
    seen = [v for v in values[max(0, end - rows + 1) : end + 1] if v is not None]
    with np.errstate(all="ignore"):
        return float(np.std(np.array(seen, float))) if seen else None


@pytest.mark.parametrize("windows", [(6, 24), (24, 6), (2, 7, 13, 50), (50,), (120, 23)])
@pytest.mark.parametrize("max_rows", [None, 40])
def test_deviations_match_brute_force(spark, windows, max_rows):
    rng = np.random.default_rng(7)
    values = [None if rng.random() < 0.2 else 1e6 * (i > 200) + round(float(rng.normal(50, 3)), 2) for i in range(300)]
    values[80:115] = [None] * 35
    values[140] = np.inf
    df = one_series(spark, values)
    made = features.window_columns(df, "std", ["x"], windows, keys=["series"], max_rows=max_rows).orderBy("timestamp").collect()
    assert [r["x"] for r in made] == values
    for w in windows:
        got, want = [r[f"x_std_{w}h"] for r in made], [population_std(values, i, w) for i in range(len(values))]
        assert [v is None for v in got] == [v is None for v in want]
        np.testing.assert_allclose([np.nan if v is None else v for v in got], [np.nan if v is None else v for v in want], rtol=1e-9, atol=1e-9)
        assert [v is not None and np.isnan(v) for v in got] == [v is not None and np.isnan(v) for v in want]


@pytest.mark.parametrize("value", [0.1, -1e-6, 1e9 / 3, 0.0])
def test_equal_values_do_not_deviate_at_all(spark, value):
    values = [value if i % 7 and not 20 < i < 60 else None for i in range(100)]
    made = features.window_columns(one_series(spark, values), "std", ["x"], (6, 13, 24), keys=["series"], max_rows=None)
    assert {v for r in made.select("x_std_6h", "x_std_13h", "x_std_24h").collect() for v in r} == {0.0, None}


@pytest.mark.parametrize("windows", [(24,), (2, 6, 24), (3, 700)])
def test_deviations_do_not_add_up_each_window_anew(spark, windows):
    made = features.window_columns(one_series(spark, [1.0]), "std", ["x"], windows, keys=["series"], max_rows=None)
    frames = re.findall(r"RowFrame, ([^,]+), ([^)]+?)\)", made._jdf.queryExecution().optimizedPlan().toString())
    assert frames and all(first == last for first, last in frames)
