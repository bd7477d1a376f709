"""Hidden Markov regimes against enumeration of all paths, and stitched against unstitched blocks."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest

from tideshift.operators import hmm

MODEL = hmm.HmmModel(
    ("x", "y"),
    np.array([0.5, 0.2, 0.3]),
    np.array([[0.8, 0.1, 0.1], [0.2, 0.7, 0.1], [0.25, 0.25, 0.5]]),
    np.array([[0.0, 1.0], [2.0, -1.0], [4.0, 0.0]]),
    np.array([[1.0, 0.5], [0.7, 1.2], [1.5, 0.8]]),
)


def simulate(n: int, seed: int, series: int = 0) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    state, rows = 0, []
    for i in range(n):
        state = rng.choice(3, p=MODEL.transitions[state]) if i else rng.choice(3, p=MODEL.start)
        x, y = rng.normal(MODEL.means[state], np.sqrt(MODEL.variances[state]))
        rows.append((series, pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i), x, y, state))
    return pd.DataFrame(rows, columns=["series", "timestamp", "x", "y", "state"])


def density(x: np.ndarray) -> np.ndarray:
    d = (x[:, None, :] - MODEL.means) ** 2 / MODEL.variances + np.log(2 * np.pi * MODEL.variances)
    return -0.5 * d.sum(-1)


def enumerate_paths(x: np.ndarray):
    b, n = density(x), len(x)
    scores = {}
    for path in itertools.product(range(3), repeat=n):
        s = np.log(MODEL.start[path[0]]) + b[0, path[0]]
        for t in range(1, n):
            s += np.log(MODEL.transitions[path[t - 1], path[t]]) + b[t, path[t]]
        scores[path] = s
    best = max(scores, key=scores.get)
    total = np.logaddexp.reduce(list(scores.values()))
    gamma = np.zeros((n, 3))
    for path, s in scores.items():
        for t, k in enumerate(path):
            gamma[t, k] += np.exp(s - total)
    return best, gamma, total


@pytest.fixture(scope="module")
def short(spark):
    frames = [simulate(n, seed=n, series=n) for n in range(1, 7)]
    return frames, spark.createDataFrame(pd.concat(frames).drop(columns="state"))


@pytest.mark.parametrize("block_rows", [100, 2, 1])
def test_short_series_match_enumeration(short, block_rows):
    frames, df = short
    packed = hmm.pack(df, MODEL.columns, ["series"], block_rows=block_rows)
    decoded = hmm.decode(packed, MODEL).toPandas().sort_values(["series", "timestamp"])
    gamma = hmm.posterior(packed, MODEL).toPandas().sort_values(["series", "timestamp"])
    likes = hmm.log_likelihood(packed, MODEL).toPandas().set_index("series")["log_likelihood"]
    for frame in frames:
        best, expected, total = enumerate_paths(frame[["x", "y"]].to_numpy())
        series = frame["series"].iloc[0]
        assert decoded[decoded.series == series]["regime_id"].tolist() == list(best)
        mine = gamma[gamma.series == series][[f"regime_proba_{k}" for k in range(3)]].to_numpy()
        np.testing.assert_allclose(mine, expected, atol=1e-9)
        np.testing.assert_allclose(mine.sum(1), 1.0, atol=1e-12)
        assert likes[series] == pytest.approx(total, abs=1e-9)


def test_blocks_and_levels_do_not_change_the_result(spark, monkeypatch):
    df = spark.createDataFrame(simulate(300, seed=9).drop(columns=["state", "series"]))
    whole = hmm.pack(df, MODEL.columns)
    monkeypatch.setattr(hmm, "FAN", 4)
    cut = hmm.pack(df, MODEL.columns, block_rows=7)
    assert (whole.longest, cut.longest) == (1, 43)
    a, b = (hmm.decode(p, MODEL).toPandas().sort_values("timestamp") for p in (whole, cut))
    assert a["regime_id"].tolist() == b["regime_id"].tolist()
    a, b = (hmm.posterior(p, MODEL).toPandas().sort_values("timestamp").drop(columns="timestamp") for p in (whole, cut))
    np.testing.assert_allclose(a.to_numpy(), b.to_numpy(), atol=1e-9)
    np.testing.assert_allclose(hmm._expectation(whole, MODEL), hmm._expectation(cut, MODEL), rtol=1e-8, atol=1e-8)


def test_fit_gains_and_recovers(spark):
    frame = simulate(1500, seed=4)
    df = spark.createDataFrame(frame.drop(columns=["state", "series"]))
    model = hmm.fit(df, MODEL.columns, n_iter=15, block_rows=500)
    assert all(b >= a - 1e-6 for a, b in zip(model.trace, model.trace[1:]))
    order = np.argsort(model.means[:, 0])
    np.testing.assert_allclose(model.means[order], MODEL.means, atol=0.5)
    labels = hmm.attach_regimes(df, model, block_rows=500).toPandas().sort_values("timestamp")
    rank = {int(k): i for i, k in enumerate(order)}
    assert (labels["regime_id"].map(rank).to_numpy() == frame["state"].to_numpy()).mean() > 0.85
    assert labels["regime_name"].notna().all()


def test_model_survives_storage(spark, tmp_path):
    hmm.save_model(spark, MODEL, str(tmp_path / "m"))
    back = hmm.load_model(spark, str(tmp_path / "m"))
    assert back.columns == MODEL.columns
    for name in ("start", "transitions", "means", "variances"):
        np.testing.assert_array_equal(getattr(back, name), getattr(MODEL, name))


def long_frame(spark):
    frames = [simulate(n, seed=n, series=n) for n in (1, 9, 40, 173)]
    return spark.createDataFrame(pd.concat(frames).drop(columns="state"))


@pytest.mark.parametrize("block_rows", [20, 1000])
def test_rounds_in_one_stage_equal_rounds_as_jobs(spark, monkeypatch, block_rows):
    blocks = hmm.pack(long_frame(spark), ("x", "y"), ["series"], block_rows=block_rows)
    begin = hmm.HmmModel(MODEL.columns, MODEL.start, MODEL.transitions, MODEL.means + 0.3, MODEL.variances)
    if block_rows == 20:  # series that do not fit into a task
        monkeypatch.setattr(hmm, "TASK_VALUES", 60)
    one = hmm.fit(None, ("x", "y"), blocks=blocks, start_from=begin, n_iter=2, tol=-1.0, one_stage=True)
    jobs = hmm.fit(None, ("x", "y"), blocks=blocks, start_from=begin, n_iter=2, tol=-1.0, one_stage=False)
    assert len(one.trace) == 2 and np.allclose(one.trace, jobs.trace) and np.isclose(one.log_likelihood, jobs.log_likelihood)
    for name in ("start", "transitions", "means", "variances"):
        assert np.allclose(getattr(one, name), getattr(jobs, name))


def test_stages_go_on_from_the_last_model(spark, monkeypatch):
    blocks = hmm.pack(long_frame(spark), ("x", "y"), ["series"], block_rows=50)
    whole = hmm.fit(None, ("x", "y"), blocks=blocks, start_from=MODEL, n_iter=6)
    monkeypatch.setattr(hmm, "STAGE_ROUNDS", 1 + len(whole.trace) // 2)
    parts = hmm.fit(None, ("x", "y"), blocks=blocks, start_from=MODEL, n_iter=6)
    assert len(whole.trace) == len(parts.trace) and np.allclose(whole.trace, parts.trace)
    assert np.isclose(whole.log_likelihood, parts.log_likelihood)


def test_a_lost_task_costs_the_stage_only(spark, tmp_path):
    blocks = hmm.pack(long_frame(spark), ("x", "y"), ["series"], block_rows=50)
    mark = str(tmp_path / "failed")

    def probe(turn: int) -> None:
        import os

        if turn == 1 and not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("lost")

    again = hmm._rounds_in_stage(blocks, MODEL, 3, -1.0, None, hmm.stage_tasks(blocks), probe)
    plain = hmm._rounds_in_stage(blocks, MODEL, 3, -1.0, None, hmm.stage_tasks(blocks))
    assert np.allclose(again[1], plain[1]) and len(again[1]) == 3


def test_batches_stay_small():
    """A batch holds a million feature values at most, so that what is computed from them does not grow with the partition."""
    frame = pd.DataFrame({"xs": [np.zeros(2 * 500)] * 1500})
    assert max(x.size for _, x, _ in hmm._batches(iter([frame]), 2)) <= 1_000_000


def test_many_series_are_not_cut(spark, monkeypatch):
    """Blocks shorter than a series must be stitched in each round; with many series none is cut."""
    rows = spark.range(12_000).selectExpr("id % 40 AS series", "id AS timestamp", "id % 7 * 1.0 AS x", "id % 11 * 1.0 AS y")
    seen, stage = [], hmm._rounds_in_stage

    def watched(blocks, *rest):
        seen.append((blocks.longest, blocks.count))
        return stage(blocks, *rest)

    monkeypatch.setattr(hmm, "_rounds_in_stage", watched)
    monkeypatch.setattr(hmm, "STAGE_LANES", 2, raising=False)
    many = hmm.fit(rows, ("x", "y"), keys=["series"], start_from=MODEL, n_iter=2)
    monkeypatch.setattr(hmm, "STAGE_LANES", 1000, raising=False)
    few = hmm.fit(rows, ("x", "y"), keys=["series"], start_from=MODEL, n_iter=2)
    assert seen == [(1, 40), (2, 80)] and np.allclose(many.trace, few.trace)


def test_passes_over_blocks_take_few_at_a_time(spark, monkeypatch):
    """A row of the packed table is a whole block; Spark's own batches would hold thousands of them."""
    rows = spark.range(12_000).selectExpr("id % 300 AS series", "id AS timestamp", "id % 7 * 1.0 AS x", "id % 11 * 1.0 AS y")
    blocks = hmm.pack(rows, ("x", "y"), ["series"])

    def sizes(model):
        return lambda frames: (pd.DataFrame({"stats": [[1.0, float(len(f))]]}) for f in frames)

    monkeypatch.setattr(hmm, "_sufficient_statistics", sizes)
    monkeypatch.setattr(hmm, "BATCH_VALUES", 400)  # a block has 40 rows of two values
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    batches, total = hmm._expectation(blocks, MODEL)
    assert total == 300 and batches >= 60
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_start_keeps_no_rows_in_the_heap(spark, monkeypatch):
    seen = []

    class Centres:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            seen.append((rows.storageLevel.useMemory, rows.storageLevel.useDisk, rows.count()))
            return self

        def clusterCenters(self):
            return [np.zeros(2)] * 3

    monkeypatch.setattr(hmm, "KMeans", Centres)
    hmm.initial_model(hmm.pack(long_frame(spark), ("x", "y"), ["series"]))
    assert seen == [(False, True, 223)]
