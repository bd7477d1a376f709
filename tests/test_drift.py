"""Drift tests against brute force and numpy."""

from __future__ import annotations

import itertools
import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideshift.functions.kolmogorov import asymptotic_p, exact_p_value
from tideshift.operators import drift


def brute_p(d, n, m):
    total = hits = 0
    for chosen in itertools.combinations(range(n + m), n):
        i = j = 0
        worst = 0
        picked = set(chosen)
        for t in range(n + m):
            i, j = (i + 1, j) if t in picked else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        total += 1
        hits += worst >= round(d * n * m)
    return hits / total


@pytest.mark.parametrize(("n", "m"), [(4, 4), (5, 3), (6, 4), (7, 5)])
def test_exact_p_counts_interleavings(n, m):
    common = math.lcm(n, m)  # distances are multiples of 1 / common
    for step in range(common + 1):
        d = step / common
        assert exact_p_value(d, n, m) == pytest.approx(brute_p(d, n, m), abs=1e-10)


def test_exact_and_limit_agree_on_large_samples(spark):
    rows = spark.createDataFrame([(0.05,), (0.03,), (0.0,)], "d double")
    limit = [r[0] for r in rows.select(asymptotic_p(F.col("d"), F.lit(3000), F.lit(2500))).collect()]
    exact = [exact_p_value(d, 3000, 2500) for d in (0.05, 0.03, 0.0)]
    assert limit == pytest.approx(exact, abs=0.01)


def reference_tests(a, b):
    values = np.sort(np.concatenate([a, b]))
    fa, fb = (np.searchsorted(np.sort(x), values, side="right") / len(x) for x in (a, b))
    area = (np.abs(fa - fb)[:-1] * np.diff(values)).sum()
    bins = np.linspace(values[0], values[-1], 51)
    p, q = ((np.histogram(x, bins=bins)[0] + 1e-10) / (len(x) + 1e-10 * 50) for x in (b, a))
    return np.abs(fa - fb).max(), area, (p * np.log(p / q)).sum()


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


@pytest.mark.parametrize("shift", [0.0, 0.4, 5.0])
def test_distances_match_numpy(spark, shift):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(shift, 1.3, 120), 1)
    got = drift.distances(frame(spark, x=a), frame(spark, x=b), ["x"]).first()
    expected = reference_tests(a, b)
    assert (got["ks_statistic"], got["wasserstein_distance"], got["kl_divergence"]) == pytest.approx(expected, abs=1e-9)


def test_edges_of_bins(spark):
    a, b = np.arange(0, 51) * 0.1, np.arange(0, 51, 2) * 0.1
    got = drift.distances(frame(spark, x=a), frame(spark, x=b), ["x"]).first()
    assert got["kl_divergence"] == pytest.approx(reference_tests(a, b)[2], abs=1e-9)


def test_special_cases(spark):
    same = np.random.default_rng(2).normal(0, 1, 50)
    few = np.r_[np.zeros(5), np.full(45, np.nan)]
    a = frame(spark, same=same, constant=np.ones(50), few=few)
    rows = {r["feature"]: r for r in drift.feature_drift(a, a, ["same", "constant", "few"]).collect()}
    assert not rows["same"]["drift_detected"] and rows["same"]["severity"] == "low" and rows["same"]["ks_pvalue"] == 1.0
    assert rows["constant"]["kl_divergence"] == pytest.approx(0.0) and not rows["constant"]["drift_detected"]
    assert rows["few"]["reason"] == "insufficient_data" and rows["few"]["ks_statistic"] is None
    assert not rows["few"]["drift_detected"]


def test_regime_drift(spark):
    ref = frame(spark, regime_id=[0] * 60 + [1] * 40)
    cur = frame(spark, regime_id=[0] * 10 + [1] * 30 + [2] * 10)
    got = drift.regime_drift(ref, cur).first()
    expected = (10 - 30) ** 2 / 30 + (30 - 20) ** 2 / 20 + (10 - 1e-10) ** 2 / 1e-10
    assert got["chi2_statistic"] == pytest.approx(expected) and got["severity"] == "high"
    assert got["current_distribution"] == {0: 0.2, 1: 0.6, 2: 0.2} and got["reference_distribution"] == {0: 0.6, 1: 0.4}


def test_reference_needs_enough_rows(spark):
    df = spark.range(150).select(F.col("id").alias("t"), (F.col("id") % 2 + (F.col("id") > 99).cast("int") * 0).alias("k"))
    assert drift.reference_rows(df, ["t"], ["k"], rows=1000, minimum=76).count() == 0
    assert drift.reference_rows(df, ["t"], ["k"], rows=60, minimum=50).count() == 120
    assert drift.reference_rows(df, ["t"]).count() == 150
    assert drift.reference_rows(df, ["t"], minimum=151).count() == 0
    assert sorted(r["t"] for r in drift.current_rows(df, ["t"], rows=3).collect()) == [147, 148, 149]


def test_alerts(spark):
    now = datetime(2024, 1, 2, 12)
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 12), "high"), (datetime(2024, 1, 1, 13), "Medium")], "timestamp timestamp_ntz, severity string")
    recent = drift.recent_alerts(rows, 24, now)
    assert [r["severity"] for r in recent.collect()] == ["Medium"]
    gate = lambda df, level: drift.alert_gate(df, level).first()["send"]
    assert gate(recent, "medium") and not gate(recent, "high") and gate(recent, "no such level")
    assert not gate(rows.limit(0), "low")
    odd = spark.createDataFrame([("strange",)], "severity string")
    assert gate(odd, "low") and not gate(odd, "medium")
