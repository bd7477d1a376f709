"""Hidden Markov and change-point regimes, training, routing to models, runs and registry."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideshift.operators import changepoints, hmm, metrics, registry, scaling, scoring, training
from tideshift.operators.features import drop_incomplete, window_columns
from tideshift.operators.regimes import rule_regime
from tideshift.plans.views import keyed, rounded, sql_round, table, with_views
from tideshift.session import scratch_path, settle

# One row per series and day, so a series has a few thousand rows at any scale and needs no size check.
KEY = {"keys": ("series",), "max_rows": None}
COLUMNS = ("wind_speed", "energy_production")
MEASURES = ("wind_speed", "energy_production", "temperature", "price")

# A detector as fitted elsewhere, so that decoding and probabilities can be checked by SQL.
MODEL = hmm.HmmModel(
    COLUMNS,
    np.array([0.5, 0.3, 0.2]),
    np.array([[0.8, 0.15, 0.05], [0.2, 0.6, 0.2], [0.1, 0.3, 0.6]]),
    np.array([[3.0, 15.0], [5.0, 30.0], [9.0, 60.0]]),
    np.array([[4.0, 100.0], [9.0, 200.0], [25.0, 600.0]]),
)

# Fits take the operators' own settings: 100 rounds, 100 deep trees, 50 epochs, at most 200 rounds of a Markov fit. Only what
# ``run_log`` lists, and ``score_routed`` scores with, are reduced models: the SQL of ``run_log`` states their depths.
SETTINGS = training.Settings(tree_depth=3, rounds=3, forest_trees=4, forest_depth=4, epochs=30)

# What a session has fitted for a folder of tables: several queries look at the same fit from different sides.
_FITTED: dict[tuple, object] = {}


def _once(spark, sf, what: str, make):
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def packed(spark, sf) -> hmm.Blocks:
    return hmm.pack(keyed(spark, sf), COLUMNS, **KEY)


def fitted(spark, sf) -> hmm.HmmModel:
    """All standardised measures of all series; a fit of its own for each query."""
    rows = keyed(spark, sf)
    scaled = scaling.apply_scaler(rows, scaling.fit_scaler(rows, MEASURES, "zscore"))
    # One narrow pass is a job of 0.4 to 0.7 seconds on the smaller tables, and an exchange of a barrier stage takes 1.1 to 1.4.
    return hmm.fit(scaled, MEASURES, one_stage=False, **KEY)


def em_step(spark, sf) -> DataFrame:
    """The model after one round from a given one."""
    step = hmm.fit(None, COLUMNS, blocks=packed(spark, sf), start_from=MODEL, n_iter=1)
    return rounded(hmm.model_table(spark, step).where("kind <> 'log_likelihood'"))


def model_roundtrip(spark, sf) -> DataFrame:
    path = scratch_path(spark, "regime-model")
    hmm.save_model(spark, fitted(spark, sf), path)
    return hmm.model_table(spark, hmm.load_model(spark, path))


def training_rows(spark, sf) -> DataFrame:
    """Window means and lags of the keyed series with the rule regime."""
    rows = window_columns(keyed(spark, sf), "mean", windows=[6, 24], **KEY)
    return rule_regime(drop_incomplete(window_columns(rows, "lag", windows=[1], **KEY)))


FEATURES = [f"{c}_{k}" for c in ("wind_speed", "energy_production", "temperature", "price") for k in ("ma_6h", "ma_24h", "lag_1h")]
IDENTITY = ("series", "timestamp")


def trained(spark, sf, settings: training.Settings = SETTINGS) -> tuple[training.Trained, str, DataFrame]:
    """All regimes trained with their default models, the table of their runs, and the rows, stored by regime."""

    def make() -> tuple[training.Trained, str, DataFrame]:
        runs = scratch_path(spark, "runs")
        needed = dict.fromkeys([*IDENTITY, "energy_production", *FEATURES, "regime_id"])
        rows = settle(training_rows(spark, sf).select(*needed), by=("regime_id",))
        found = training.train_regimes(
            rows, FEATURES, IDENTITY, settings=settings, path=scratch_path(spark, "models"), runs_path=runs, stored=True
        )
        return found, runs, rows

    return _once(spark, sf, f"models {settings}", make)


def train_all(spark, sf) -> DataFrame:
    """What each regime was trained on, and whether its model was tested: errors are there and in their order."""
    results = training.result_table(spark, trained(spark, sf, training.Settings())[0])
    tested = (F.col("mae") > 0) & (F.col("rmse") >= F.col("mae"))
    return results.select("regime_id", "model_name", "n_samples", "n_left_out", tested.alias("tested"))


def fit_one(name: str):
    """One model over all rows: sizes of both parts, and whether it errs less on the test rows than their spread."""

    def query(spark, sf) -> DataFrame:
        rows = settle(training_rows(spark, sf).select(*IDENTITY, "energy_production", *FEATURES))
        train, test = training.split_rows(rows, IDENTITY)
        model = training.FITTERS[name](train, FEATURES, "energy_production")
        scored = model.transform(test).select("energy_production", "prediction")
        error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("energy_production"), 2)))
        tested = scored.agg(F.count("prediction").alias("n_test"), (error < F.stddev_pop("energy_production")).alias("learned"))
        return tested.crossJoin(train.agg(F.count(F.lit(1)).alias("n_train"))).withColumn("model_name", F.lit(name))

    return query


def split(spark, sf) -> DataFrame:
    train, test = training.split_rows(keyed(spark, sf).select(*IDENTITY), IDENTITY)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def split_temporal(spark, sf) -> DataFrame:
    """Bounds of both parts: no training row is later than a test row."""
    train, test = training.split_by_time(keyed(spark, sf))
    bounds = [F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("n_rows")]
    return train.agg(*bounds).withColumn("part", F.lit("train")).unionByName(test.agg(*bounds).withColumn("part", F.lit("test")))


def routed(spark, sf) -> DataFrame:
    """Each row scored by the stored model of its regime."""
    found, _, rows = trained(spark, sf)
    models = {k: training.load_regressor(spark, stored, name) for k, name, *_, stored in found.results}
    scored = scoring.score_routed(rows, models, found.names)
    return scored.select(*IDENTITY, "regime_id", "model_name", F.col("prediction").isNotNull().alias("scored"))


def run_log(spark, sf) -> DataFrame:
    """Run records of the trained regimes, as stored."""
    runs = spark.read.parquet(trained(spark, sf)[1])
    return runs.select(
        "run_name", runs.tags["model_type"].alias("model_type"), runs.params["max_depth"].alias("max_depth"),
        runs.params["n_samples"].cast("long").alias("n_samples"), (runs.metrics["mae"] > 0).alias("has_error"),
    )


def hmm_gain(spark, sf) -> DataFrame:
    """Whether each round of the fit gained, and whether the result is a model."""
    model = fitted(spark, sf)
    gains = np.diff(model.trace)
    return spark.createDataFrame(
        [(model.n_regimes, bool((gains > -1e-6).all()), bool(np.allclose(model.transitions.sum(1), 1)))],
        "n_regimes int, gained boolean, stochastic boolean",
    )


# ---- registry: each order registers a version of a model --------------------------------------


def registrations(spark, sf) -> DataFrame:
    stage = F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging").otherwise("None")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("regime_"), F.substring("o_orderpriority", 1, 1)).alias("name"),
        F.col("o_orderdate").alias("registered_at"),
        F.col("o_orderkey").alias("run_id"),
        stage.alias("stage"),
    )


def versions(spark, sf) -> DataFrame:
    """Versions of the years before 1998 first, later registrations numbered on."""
    rows, order = registrations(spark, sf), ("registered_at", "run_id")
    early = registry.assign_versions(rows.where(F.year("registered_at") < 1998), order=order)
    late = registry.assign_versions(rows.where(F.year("registered_at") >= 1998), early, order=order)
    return early.unionByName(late)


NAMES = {0: "regime_1", 1: "regime_2", 2: "regime_3"}

QUERIES = {
    "hmm_fit": lambda s, d: hmm.model_table(s, fitted(s, d)),
    "hmm_gain": hmm_gain,
    "hmm_em_step": em_step,
    "hmm_label_counts": lambda s, d: hmm.label_counts(hmm.decode(packed(s, d), MODEL)),
    "hmm_decode": lambda s, d: hmm.decode(packed(s, d), MODEL),
    "hmm_posterior": lambda s, d: rounded(hmm.posterior(packed(s, d), MODEL)),
    "hmm_loglik": lambda s, d: rounded(hmm.log_likelihood(packed(s, d), MODEL)),
    "regime_attach": lambda s, d: rounded(hmm.attach_regimes(keyed(s, d), MODEL, **KEY)),
    "regime_model_roundtrip": model_roundtrip,
    "cpd_breakpoints": lambda s, d: changepoints.change_points(keyed(s, d), "energy_production", keys=KEY["keys"]),
    "cpd_regimes": lambda s, d: changepoints.attach_change_point_regimes(keyed(s, d), "energy_production", **KEY),
    "train_all": train_all,
    "split": split,
    "split_temporal": split_temporal,
    "fit_gbt": fit_one("boosted_trees"),
    "fit_rf": fit_one("random_forest"),
    "fit_mlp": fit_one("neural"),
    "score_routed": routed,
    "run_log": run_log,
    "registry_promote": versions,
    "registry_latest": lambda s, d: registry.latest_versions(versions(s, d)),
    "registry_models": lambda s, d: registry.list_models(versions(s, d)).select(
        "name", F.size("latest_versions").alias("n_stages"), F.element_at("latest_versions", -1)["version"].alias("highest")
    ),
    "registry_pick": lambda s, d: registry.pick_models(versions(s, d), NAMES),
    "metric_models_loaded": lambda s, d: metrics.models_loaded(
        registry.pick_models(versions(s, d), NAMES).withColumnRenamed("name", "model_name")
    ),
}


# ---- SQL --------------------------------------------------------------------------------------


def _emissions() -> str:
    parts = []
    for k in range(3):
        v = MODEL.variances[k]
        terms = " + ".join(f"({c} - {m:e}) * ({c} - {m:e}) / {w:e}" for c, m, w in zip(COLUMNS, MODEL.means[k], v))
        parts.append(f"-5e-1 * ({terms} + {float(np.log(2 * np.pi * v).sum())!r}::DOUBLE) AS l{k}")
    return f"""o AS (SELECT series, timestamp, row_number() OVER (PARTITION BY series ORDER BY timestamp) AS t,
        count(*) OVER (PARTITION BY series) AS n, {', '.join(parts)} FROM keyed),
      e AS (SELECT *, greatest(l0, l1, l2) AS top, exp(l0 - greatest(l0, l1, l2)) AS b0, exp(l1 - greatest(l0, l1, l2)) AS b1,
        exp(l2 - greatest(l0, l1, l2)) AS b2 FROM o)"""


def _a(i: int, j: int) -> str:
    return f"{MODEL.transitions[i, j]:e}"


def _la(i: int, j: int) -> str:
    return f"{float(np.log(MODEL.transitions[i, j]))!r}::DOUBLE"


_FORWARD = f"""f AS (
    SELECT series, t, x0 / (x0 + x1 + x2) AS a0, x1 / (x0 + x1 + x2) AS a1, x2 / (x0 + x1 + x2) AS a2, ln(x0 + x1 + x2) + top AS ll
    FROM (SELECT series, t, top, {', '.join(f'{MODEL.start[k]:e} * b{k} AS x{k}' for k in range(3))} FROM e WHERE t = 1)
    UNION ALL
    SELECT series, t, x0 / (x0 + x1 + x2), x1 / (x0 + x1 + x2), x2 / (x0 + x1 + x2), ll + ln(x0 + x1 + x2) + top
    FROM (SELECT e.series, e.t, e.top, f.ll, {', '.join('(' + ' + '.join(f'f.a{i} * {_a(i, j)}' for i in range(3)) + f') * e.b{j} AS x{j}' for j in range(3))}
          FROM f JOIN e ON e.series = f.series AND e.t = f.t + 1))"""
_BACKWARD = f"""g AS (
    SELECT series, t, 1e0 AS g0, 1e0 AS g1, 1e0 AS g2 FROM e WHERE t = n
    UNION ALL
    SELECT series, t, y0 / (y0 + y1 + y2), y1 / (y0 + y1 + y2), y2 / (y0 + y1 + y2)
    FROM (SELECT e.series, e.t - 1 AS t, {', '.join('(' + ' + '.join(f'{_a(i, j)} * e.b{j} * g.g{j}' for j in range(3)) + f') AS y{i}' for i in range(3))}
          FROM g JOIN e ON e.series = g.series AND e.t = g.t WHERE g.t > 1))"""
_GAMMA = f"""gm AS (SELECT e.series, e.timestamp, {', '.join(f'a{k} * g{k} / (a0 * g0 + a1 * g1 + a2 * g2) AS p{k}' for k in range(3))}
    FROM e JOIN f ON e.series = f.series AND e.t = f.t JOIN g ON e.series = g.series AND e.t = g.t)"""


def _best(j: int) -> str:
    options = [f"(d{i} + {_la(i, j)})" for i in range(3)]
    return f"greatest({', '.join(options)})", (
        f"CASE WHEN {options[0]} >= {options[1]} AND {options[0]} >= {options[2]} THEN 0 WHEN {options[1]} >= {options[2]} THEN 1 ELSE 2 END"
    )


_PATH = f"""v AS (
    SELECT series, t, {', '.join(f'{float(np.log(MODEL.start[k]))!r}::DOUBLE + l{k} AS d{k}' for k in range(3))}, 0 AS q0, 0 AS q1, 0 AS q2 FROM e WHERE t = 1
    UNION ALL
    SELECT e.series, e.t, {', '.join(f'{_best(j)[0]} + l{j}' for j in range(3))}, {', '.join(_best(j)[1] for j in range(3))}
    FROM v JOIN e ON e.series = v.series AND e.t = v.t + 1),
  w AS (
    SELECT v.series, v.t, CASE WHEN d0 >= d1 AND d0 >= d2 THEN 0 WHEN d1 >= d2 THEN 1 ELSE 2 END AS s FROM v JOIN e ON e.series = v.series AND e.t = v.t WHERE e.t = e.n
    UNION ALL
    SELECT v.series, v.t - 1, CASE w.s WHEN 0 THEN q0 WHEN 1 THEN q1 ELSE q2 END FROM w JOIN v ON v.series = w.series AND v.t = w.t WHERE w.t > 1),
  pt AS (SELECT e.series, e.timestamp, w.s AS regime_id FROM e JOIN w ON e.series = w.series AND e.t = w.t)"""


def _recursive(body: str) -> str:
    return with_views(f"+ {body}", "keyed").replace("WITH", "WITH RECURSIVE", 1)


def _em_step() -> str:
    """One round of expectation maximisation from ``MODEL``, its parameters as rows."""
    pairs = [(i, j) for i in range(3) for j in range(3)]
    joint = ", ".join(f"f.a{i} * {_a(i, j)} * e.b{j} * g.g{j} AS x{i}{j}" for i, j in pairs)
    total = " + ".join(f"x{i}{j}" for i, j in pairs)
    sums, out = [], []
    for k in range(3):
        sums += [f"sum(p{k}) AS w{k}", f"avg(p{k}) FILTER (t = 1) AS start{k}"]
        out.append(f"SELECT 'start' AS kind, {k} AS regime_id, NULL::INTEGER AS index, NULL::VARCHAR AS column_name, start{k} AS value FROM s")
        for d, c in enumerate(COLUMNS):
            sums += [f"sum(p{k} * {c}) / sum(p{k}) AS m{k}{d}", f"sum(p{k} * {c} * {c}) AS q{k}{d}"]
            out.append(f"SELECT 'mean', {k}, {d}, '{c}', m{k}{d} FROM s")
            out.append(f"SELECT 'variance', {k}, {d}, '{c}', ({hmm.VARIANCE_PRIOR:e} + q{k}{d} - w{k} * m{k}{d} * m{k}{d}) / w{k} FROM s")
    moves = ", ".join(f"sum(x{i}{j} / norm) AS n{i}{j}" for i, j in pairs)
    out += [f"SELECT 'transition', {i}, {j}, NULL, n{i}{j} / ({' + '.join(f'n{i}{n}' for n in range(3))}) FROM n" for i, j in pairs]
    return _recursive(f"""{_emissions()}, {_FORWARD}, {_BACKWARD}, {_GAMMA},
      gs AS (SELECT gm.*, e.t, k.wind_speed, k.energy_production FROM gm JOIN e ON gm.series = e.series AND gm.timestamp = e.timestamp
             JOIN keyed k ON gm.series = k.series AND gm.timestamp = k.timestamp),
      s AS MATERIALIZED (SELECT {', '.join(sums)} FROM gs),
      xi AS (SELECT *, {total} AS norm FROM (SELECT {joint} FROM f JOIN e ON e.series = f.series AND e.t = f.t + 1
             JOIN g ON g.series = e.series AND g.t = e.t)),
      n AS MATERIALIZED (SELECT {moves} FROM xi),
      m AS ({' UNION ALL '.join(out)})
      SELECT kind, regime_id, index, column_name, {sql_round('value', 'value')} FROM m""")


_PROBABILITIES = ", ".join(sql_round(f"p{k}", f"regime_proba_{k}") for k in range(3))
_STAGE = "CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'None' END"
_VERSIONS = f"""vs AS (SELECT 'regime_' || o_orderpriority[1] AS name, o_orderdate AS registered_at, o_orderkey AS run_id, {_STAGE} AS stage,
    row_number() OVER (PARTITION BY o_orderpriority[1] ORDER BY o_orderdate, o_orderkey) AS version FROM orders)"""

_TRAINING = """l AS (SELECT *, CASE WHEN wind_speed > 10 THEN 0 WHEN wind_speed > 5 THEN 1 ELSE 2 END AS regime_id,
    row_number() OVER (PARTITION BY series ORDER BY timestamp) AS rn FROM keyed), tr AS (SELECT * FROM l WHERE rn > 1)"""
_MODEL_NAME = "CASE regime_id WHEN 0 THEN 'boosted_trees' WHEN 1 THEN 'neural' ELSE 'random_forest' END"
_FIT = f"""+ {_TRAINING}, p AS (SELECT CASE WHEN substr(md5(series || '|' || timestamp::VARCHAR || '|42'), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS part FROM tr)
    SELECT count(*) FILTER (part = 'test') AS n_test, TRUE AS learned, count(*) FILTER (part = 'train') AS n_train, '{{}}' AS model_name FROM p"""

ORACLE = {
    "hmm_gain": "SELECT 3 AS n_regimes, TRUE AS gained, TRUE AS stochastic",
    "train_all": with_views(
        f"+ {_TRAINING} SELECT regime_id, {_MODEL_NAME} AS model_name, count(*) AS n_samples, 0 AS n_left_out, TRUE AS tested FROM tr GROUP BY 1 HAVING count(*) >= 50", "keyed"),
    "fit_gbt": with_views(_FIT.format("boosted_trees"), "keyed"),
    "fit_rf": with_views(_FIT.format("random_forest"), "keyed"),
    "fit_mlp": with_views(_FIT.format("neural"), "keyed"),
    "score_routed": with_views(
        f"""+ {_TRAINING}, k AS (SELECT regime_id FROM tr GROUP BY 1 HAVING count(*) >= 50)
        SELECT series, timestamp, tr.regime_id, CASE WHEN k.regime_id IS NULL THEN 'mock' ELSE {_MODEL_NAME.replace('regime_id', 'tr.regime_id')} END AS model_name, TRUE AS scored
        FROM tr LEFT JOIN k ON tr.regime_id = k.regime_id""", "keyed"),
    "run_log": with_views(
        f"""+ {_TRAINING} SELECT 'regime_' || regime_id || '_' || {_MODEL_NAME} AS run_name, CASE regime_id WHEN 1 THEN 'network' ELSE 'trees' END AS model_type,
        CASE regime_id WHEN 0 THEN '3' WHEN 2 THEN '4' END AS max_depth, count(*) AS n_samples, TRUE AS has_error FROM tr GROUP BY regime_id HAVING count(*) >= 50""", "keyed"),
    "hmm_em_step": _em_step(),
    "hmm_label_counts": _recursive(f"{_emissions()}, {_PATH} SELECT regime_id, count(*) AS n_rows FROM pt GROUP BY regime_id"),
    "hmm_decode": _recursive(f"{_emissions()}, {_PATH} SELECT * FROM pt"),
    "hmm_posterior": _recursive(f"{_emissions()}, {_FORWARD}, {_BACKWARD}, {_GAMMA} SELECT series, timestamp, {_PROBABILITIES} FROM gm"),
    "hmm_loglik": _recursive(
        f"{_emissions()}, {_FORWARD} SELECT e.series, {sql_round('ll', 'log_likelihood')} FROM f JOIN e ON e.series = f.series AND e.t = f.t WHERE e.t = e.n"
    ),
    "regime_attach": _recursive(
        f"""{_emissions()}, {_FORWARD}, {_BACKWARD}, {_GAMMA}, {_PATH}
        SELECT k.*, regime_id, {_PROBABILITIES}, CASE regime_id WHEN 0 THEN 'volatile' WHEN 1 THEN 'neutral' ELSE 'stable' END AS regime_name
        FROM keyed k JOIN gm ON k.series = gm.series AND k.timestamp = gm.timestamp JOIN pt ON k.series = pt.series AND k.timestamp = pt.timestamp"""
    ),
    "split": with_views(
        """SELECT series, timestamp, CASE WHEN substr(md5(series || '|' || timestamp::VARCHAR || '|42'), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS part
        FROM keyed""", "keyed"),
    "split_temporal": with_views(
        """+ c AS (SELECT quantile_disc(timestamp, 0.8) AS cut FROM keyed)
        SELECT CASE WHEN timestamp > cut THEN 'test' ELSE 'train' END AS part, min(timestamp) AS first, max(timestamp) AS last, count(*) AS n_rows
        FROM keyed, c GROUP BY 1""", "keyed"),
    "metric_models_loaded": f"""WITH {_VERSIONS} SELECT count(DISTINCT name) AS models_loaded,
        string_agg(DISTINCT 'regime_' || (CAST(name[8] AS INTEGER) - 1) || ':' || name, ',' ORDER BY 'regime_' || (CAST(name[8] AS INTEGER) - 1) || ':' || name) AS models
        FROM vs WHERE stage = 'Production' AND name <= 'regime_3'""",
    "registry_promote": f"WITH {_VERSIONS} SELECT * FROM vs",
    "registry_latest": f"WITH {_VERSIONS} SELECT * FROM vs QUALIFY row_number() OVER (PARTITION BY name, stage ORDER BY version DESC) = 1",
    "registry_models": f"WITH {_VERSIONS} SELECT name, CAST(count(DISTINCT stage) AS INTEGER) AS n_stages, max(version) AS highest FROM vs GROUP BY 1",
    "registry_pick": f"""WITH {_VERSIONS} SELECT *, CAST(name[8] AS INTEGER) - 1 AS regime_id FROM vs WHERE stage = 'Production' AND name <= 'regime_3'
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
}
