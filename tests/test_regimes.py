"""Change points, labels, training, scoring and the registry."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideshift.operators import changepoints, neural, regimes, registry, scoring, training
from tideshift.operators.neural import fit_neural
from tideshift.plans import model_queries

T0 = pd.Timestamp("2024-01-01")


def frame(spark, **columns):
    n = len(next(iter(columns.values())))
    return spark.createDataFrame(pd.DataFrame({"timestamp": T0 + pd.to_timedelta(np.arange(n), unit="h"), **columns}))


def scatter(x):
    """Cost of every segment from the whole kernel matrix."""
    at = np.ceil(np.arange(257) / 256 * len(x)).astype(int) - 1
    width = changepoints.bandwidth(np.sort(x)[np.maximum(at, 0)])
    k = np.exp(-np.clip((x[:, None] - x[None, :]) ** 2 / width, *changepoints.DISTANCE_BOUNDS))
    np.fill_diagonal(k, 1.0)
    return lambda a, b: (b - a) - k[a:b, a:b].sum() / (b - a)


def cheapest(x, penalty, min_size, step):
    """All segmentations on the grid."""
    n, cost_of = len(x), scatter(x)
    grid = list(range(step, n, step))
    best = (np.inf, None)
    for r in range(len(grid) + 1):
        for cuts in itertools.combinations(grid, r):
            ends = [0, *cuts, n]
            if all(b - a >= min_size for a, b in zip(ends, ends[1:])):
                cost = sum(cost_of(a, b) + penalty for a, b in zip(ends, ends[1:]))
                best = min(best, (cost, ends[1:]), key=lambda t: t[0])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_the_cheapest_segmentation(seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(rng.uniform(-3, 3), 1, rng.integers(8, 20)) for _ in range(3)])
    for penalty in (0.5, 2.0):
        found = changepoints.pelt(x, penalty, 5, 5)
        cost, ends = cheapest(x, penalty, 5, 5)
        mine = sum(scatter(x)(a, b) + penalty for a, b in zip([0, *found], found))
        assert mine == pytest.approx(cost) and found == ends


def planted(seed=0):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, 1, 150), rng.normal(8, 1, 150), rng.normal(0, 1, 200)])


def test_planted_shifts_are_found(spark):
    df = frame(spark, x=planted())
    ends = sorted(r["segment_end"] for r in changepoints.change_points(df, "x").collect())
    assert ends == changepoints.pelt(planted())
    assert len(ends) == 3 and ends[-1] == 500
    assert abs(ends[0] - 150) <= 5 and abs(ends[1] - 300) <= 5


def test_cuts_and_more_rows_change_nothing_before_them():
    """The same search however the rows arrive, and ends far before the last row stay as rows are added."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(m, 1, 190) for m in (0, 6, 0, -5, 2, 9, 1, 4)])
    whole = changepoints.Search(4.0)
    whole.feed(x)
    for size in (1, 7, 64, 333):
        parts = changepoints.Search(4.0)
        for a in range(0, len(x), size):
            parts.feed(x[a : a + size])
        assert parts.ends() == whole.ends() and len(whole.ends()) == 8
    assert len(whole.values) < len(x)  # what cannot matter any more is gone
    growing = changepoints.Search(4.0)
    growing.feed(x[:1200])
    for a in range(1200, len(x)):
        growing.feed(x[a : a + 1])
        early = [e for e in growing.ends() if e < 1000]
        assert early == [e for e in whole.ends() if e < 1000]


def test_many_series_with_missing_keys_and_values(spark):
    rng = np.random.default_rng(2)
    parts = {None: planted(1), "a": planted(2)[:333], "b": rng.normal(0, 1, 40), "c": np.full(60, 3.0)}
    rows = [(k, i, float(v)) for k, x in parts.items() for i, v in enumerate(x)] + [("d", i, None) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, timestamp int, x double").repartition(6)
    got = {}
    for r in changepoints.change_points(df, "x", ["k"]).collect():
        got.setdefault(r["k"], []).append(r["segment_end"])
    want = {k: changepoints.pelt(x) for k, x in parts.items()} | {"d": [50]}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert changepoints.change_points(df.limit(0), "x", ["k"]).count() == 0


def test_short_series_is_one_segment(spark):
    assert [r["segment_end"] for r in changepoints.change_points(frame(spark, x=[1.0] * 10), "x").collect()] == [10]


def test_labels_follow_volatility(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, x=np.concatenate([rng.normal(0, s, 40) for s in (5.0, 0.1, 1.0)] + [np.zeros(3)]))
    ends = spark.createDataFrame([(40,), (80,), (120,)], "segment_end int")
    got = regimes.label_segments(df, ends, "x").orderBy("position").toPandas()["regime_id"].tolist()
    assert got == [0] * 40 + [2] * 40 + [1] * 40 + [0] * 3
    one = regimes.label_segments(df, ends, "x", n_regimes=1).toPandas()
    assert set(one["regime_id"][:120]) == {1}
    two = regimes.one_hot(regimes.label_segments(df, ends, "x"))
    assert two.select(F.sum(F.col("regime_proba_0") + F.col("regime_proba_1") + F.col("regime_proba_2"))).first()[0] == 123


def test_buckets_round_half_to_even(spark):
    v = spark.createDataFrame([(i, float(i)) for i in range(5)], "segment int, volatility double")
    got = [r["regime_id"] for r in regimes.segment_regimes(v).orderBy("segment").collect()]
    assert got == [2 - round(i / 4 * 2) for i in range(5)]


def test_transitions(spark):
    df = frame(spark, regime_id=[0, 0, 1, 1, 2, 2, 0, 0] + [0] * 20)
    rows = regimes.transitions(df).orderBy("timestamp").collect()
    assert [(r["from_regime"], r["to_regime"]) for r in rows] == [(0, 1), (1, 2), (2, 0)]
    assert [r["timestamp"].hour for r in rows] == [2, 4, 6]
    assert regimes.transitions(df.limit(1)).columns == [
        "timestamp", "from_regime", "to_regime", "from_regime_name", "to_regime_name",
    ]


def test_scoring_rules(spark):
    rows = [(8.5, 400.0, 12.0, 150.0), (12.0, 600.0, 10.0, 120.0), (-5.0, 400.0, 12.0, 150.0), (3.0, None, 12.0, 150.0)]
    df = spark.createDataFrame(rows, "wind_speed double, energy_production double, temperature double, price double")
    scored = scoring.score_batch(df)
    counts = scoring.batch_counts(scored).first()
    assert (counts["n_succeeded"], counts["n_failed"]) == (2, 2)
    got = {r["wind_speed"]: (r["regime_id"], r["reason"]) for r in scored.collect()}
    assert got == {8.5: (1, None), 12.0: (0, None), -5.0: (None, "wind_speed"), 3.0: (None, "energy_production")}
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    noisy = scoring.score_batch(df, noise_seed=1).where("status = 'success'").select(F.col("prediction") - F.col("energy_production") * 1.05).collect()
    assert all(0 < abs(r[0]) < 60 for r in noisy)


def test_split_is_repeatable_and_complete(spark):
    df = spark.range(5000)
    train, test = training.split_rows(df, ["id"])
    again, _ = training.split_rows(df.repartition(7), ["id"])
    assert train.count() + test.count() == 5000 and 800 < test.count() < 1200
    assert train.exceptAll(again).count() == 0


def test_network_learns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, 2))
    df = frame(spark, a=x[:, 0], b=x[:, 1], y=3 * x[:, 0] - x[:, 1] + 5)
    model = fit_neural(df, ["a", "b"], "y", epochs=25, learning_rate=0.02)
    assert model.losses[-1] < model.losses[0] / 5
    error = model.transform(df).select(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 1.0


def test_training_skips_small_regimes_and_restores_models(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, 200)
    df = frame(spark, x=x, energy_production=10 + 2 * x, regime_id=[0] * 100 + [1] * 80 + [2] * 20)
    small = training.Settings(rounds=2, tree_depth=2, epochs=2)
    with pytest.raises(ValueError):
        training.train_regimes(df.drop("regime_id"), ["x"], ["timestamp"])
    found = training.train_regimes(df, ["x"], ["timestamp"], settings=small, path=str(tmp_path), split="temporal")
    assert found.names == {0: "boosted_trees", 1: "neural"}
    assert training.result_table(spark, found).count() == 2
    for k, name, *_, path in found.results:
        a = found.models[k].transform(df).select(F.sum("prediction")).first()[0]
        b = training.load_regressor(spark, path, name).transform(df).select(F.sum("prediction")).first()[0]
        assert a == pytest.approx(b)
    routed = scoring.score_routed(df, found.models, found.names)
    assert routed.count() == 200
    assert {(r[0], r[1]) for r in routed.select("regime_id", "model_name").distinct().collect()} == {(0, "boosted_trees"), (1, "neural"), (2, "mock")}


def test_registry(spark):
    rows = [("a", 1, "Staging"), ("a", 2, "Production"), ("b", 1, "Production"), ("a", 3, "Production")]
    made = registry.assign_versions(spark.createDataFrame(rows, "name string, registered_at int, stage string"))
    more = registry.assign_versions(spark.createDataFrame([("a", 4, "Staging"), ("c", 9, "None")], "name string, registered_at int, stage string"), made)
    assert {(r["name"], r["version"]) for r in more.collect()} == {("a", 4), ("c", 1)}
    everything = made.unionByName(more)
    latest = {(r["name"], r["stage"]): r["version"] for r in registry.latest_versions(everything).collect()}
    assert latest == {("a", "Staging"): 4, ("a", "Production"): 3, ("b", "Production"): 1, ("c", "None"): 1}
    picked = registry.pick_models(everything, {0: "a", 1: "b", 2: "c"})
    assert registry.effective_models({0: "local", 2: "local"}, picked) == {0: "a/3", 1: "b/1", 2: "local"}


def test_search_takes_values_in_by_pieces(monkeypatch):
    """One kernel table for many values, instead of one for each."""
    calls, add = [], changepoints.Search._add

    def counted(self, x):
        calls.append(np.size(x))
        return add(self, x)

    monkeypatch.setattr(changepoints.Search, "_add", counted)
    x = np.random.default_rng(1).normal(0, 1, 600)
    changepoints.pelt(x)
    assert sum(calls) == 600 and len(calls) <= 15


def test_tree_fits_spread_stored_rows(spark, monkeypatch):
    """However few parts the rows come in, a task of a tree fit gets a bounded number of them."""
    seen = []

    class Estimator:
        def getLabelCol(self):
            return "y"

        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return rows

    monkeypatch.setattr(training, "TASK_ROWS", 50, raising=False)
    rows = spark.range(400).coalesce(1).selectExpr("id", "id * 1.0 AS a", "id * 2.0 AS y")
    training._fit_trees(Estimator(), rows, ["a"])
    assert seen == [8]


def test_network_rows_are_taken_in_pieces():
    data = np.arange(13.0 * 10_000).reshape(-1, 13)
    parts = list(neural._pieces(data))
    assert max(map(len, parts)) <= 2048 and (np.concatenate(parts) == data).all()


def test_routing_reads_stored_rows(spark, monkeypatch):
    """The rows that were trained on are scored as stored, not derived again for each model."""
    rows = spark.createDataFrame([(1, T0.to_pydatetime(), 2.0, 0)], "series long, timestamp timestamp, energy_production double, regime_id int")
    monkeypatch.setattr(model_queries, "trained", lambda *_: (training.Trained(), "", rows))
    found = model_queries.routed(spark, "/root/testdata/sf0.001")
    assert [(r["series"], r["model_name"], r["scored"]) for r in found.collect()] == [(1, "mock", True)]


class Constant:
    """Stands in for a fitted regressor."""

    def transform(self, rows):
        return rows.withColumn("prediction", F.lit(10.0))


@pytest.mark.parametrize("query", ["fit_gbt", "fit_rf", "train_all"])
def test_registered_fits_take_the_full_settings(spark, monkeypatch, query):
    seen = []

    def fitter(train, columns, target, s=training.Settings()):
        seen.append(s)
        return Constant()

    names = dict.fromkeys(["series", "timestamp", "energy_production", *model_queries.FEATURES, "regime_id"])
    rows = spark.range(240).select(
        *[F.col("id").alias(c) if c == "series" else F.lit(T0.to_pydatetime()).alias(c) if c == "timestamp"
          else (F.col("id") % 3).cast("int").alias(c) if c == "regime_id" else (F.col("id") * 0.5).alias(c) for c in names]
    )
    monkeypatch.setattr(model_queries, "training_rows", lambda *_: rows)
    monkeypatch.setattr(training, "FITTERS", dict.fromkeys(training.FITTERS, fitter))
    monkeypatch.setattr(training, "save_regressor", lambda *_: None)
    assert model_queries.QUERIES[query](spark, f"no folder for {query}").count() > 0
    assert seen and set(seen) == {training.Settings()}


def test_registered_markov_fit_takes_all_rounds(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(model_queries, "keyed", lambda *_: spark.range(9).selectExpr("id AS series", *[f"id * 1.0 AS {c}" for c in model_queries.MEASURES]))
    monkeypatch.setattr(model_queries.hmm, "fit", lambda rows, columns, **options: seen.update(options))
    model_queries.fitted(spark, "")
    assert seen.get("n_iter", 200) == 200 and "tol" not in seen
