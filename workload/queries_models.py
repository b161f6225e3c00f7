"""Training, search, selection, evaluation report, trials and versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators import counts, split, stages, temporal
from panelwise.operators.resample import pack, smote_enn, unpack
from panelwise.plans import adaptive_search, evaluation, histogram_trees, logistic_grid, training, trial_variance
from panelwise.session import materialize, session_folder
from panelwise.sources import registry as versions
from panelwise.sources import trial_log
from workload.queries_metrics import panel_groups
from workload.queries_prepare import assign_sql
from workload.registry import query, r6
from workload.views import PANEL_SQL, ROLES, panel, scored

MODEL_FEATURES = ("reading", "level", "hour_of_day", "code")
MODEL_ROLES = ROLES.with_features(*MODEL_FEATURES)
# One setting of each family, within its search space.
SETTINGS = {
    "random_forest": {"n_estimators": 200, "max_depth": 8, "min_samples_leaf": 1, "max_features": "sqrt"},
    "logistic_regression": {"C": 1.0, "penalty": "l2", "max_iter": 1000, "tol": 1e-5},
    "gradient_boosting": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1},
}


def prepared_splits(spark, sf_dir):
    """Imputed panel with its split; the imputer is fitted on the training rows."""
    df = panel(spark, sf_dir).drop("p")
    tagged = materialize(split.split_rows(df, split.split_entities(df, ROLES), ROLES), "tagged")
    fill = stages.MeanImpute(["reading", "level"]).fit(tagged.filter("split = 'train'"))
    done = materialize(fill.transform(tagged), "prepared")
    return {name: done.filter(F.col("split") == name).drop("split") for name in split.SPLITS}


def _train(family: str, spark, sf_dir) -> DataFrame:
    parts = prepared_splits(spark, sf_dir)
    _, metrics = training.train_evaluate(family, SETTINGS[family], parts["train"], parts["val"], MODEL_ROLES)
    return metrics


@query("train_random_forest")
def _rf(spark, sf_dir) -> DataFrame:
    return _train("random_forest", spark, sf_dir)


@query("train_logistic")
def _lr(spark, sf_dir) -> DataFrame:
    return _train("logistic_regression", spark, sf_dir)


@query("train_gbt")
def _gbt(spark, sf_dir) -> DataFrame:
    return _train("gradient_boosting", spark, sf_dir)


@query("train_evaluate")
def _train_evaluate(spark, sf_dir) -> DataFrame:
    """All families on the same split, one metrics row each."""
    parts = prepared_splits(spark, sf_dir)
    _, table = training.compare_families(parts["train"], parts["val"], MODEL_ROLES, SETTINGS)
    return table


@query("cross_validate")
def _cv(spark, sf_dir) -> DataFrame:
    train = prepared_splits(spark, sf_dir)["train"]
    return training.cross_validate(
        "logistic_regression", SETTINGS["logistic_regression"], train, MODEL_ROLES
    )


@query("search_trials")
def _search(spark, sf_dir) -> DataFrame:
    train = prepared_splits(spark, sf_dir)["train"]
    return training.search_trials("logistic_regression", train, MODEL_ROLES, n_trials=3)


@query("feature_importance")
def _importance(spark, sf_dir) -> DataFrame:
    train = prepared_splits(spark, sf_dir)["train"]
    model = training.fit_model("random_forest", SETTINGS["random_forest"], train, MODEL_ROLES)
    return training.feature_importance(model, MODEL_ROLES, spark)


@query("score_batch")
def _score(spark, sf_dir) -> DataFrame:
    parts = prepared_splits(spark, sf_dir)
    model = training.fit_model("logistic_regression", SETTINGS["logistic_regression"], parts["train"], MODEL_ROLES)
    return training.score_batch(model, parts["test"], MODEL_ROLES).select("row_id", "label", "p", "yhat")


@query(
    "score_batch_checks",
    f"""WITH {assign_sql('label')}
SELECT p.label, count(*) AS n, count(*) AS n_probable, count(*) AS n_consistent
FROM panel p JOIN assign a USING (entity) WHERE a.split = 'test' GROUP BY p.label""",
)
def _score_checks(spark, sf_dir) -> DataFrame:
    """Every test row is scored once, with a probability and the prediction that follows from it."""
    p = F.col("p")
    return _score(spark, sf_dir).groupBy("label").agg(
        F.count("row_id").alias("n"),
        F.count_if((p >= 0) & (p <= 1)).alias("n_probable"),
        F.count_if((p > 0.5) == (F.col("yhat") == 1)).alias("n_consistent"),
    )


@query(
    "logistic_gradient",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(0 AS DOUBLE) AS gradient FROM (SELECT count(*) FROM events)" for c in MODEL_FEATURES),
)
def _gradient(spark, sf_dir) -> DataFrame:
    """At the fit the weighted loss with its penalty is flat in every coefficient."""
    train = prepared_splits(spark, sf_dir)["train"]
    params = SETTINGS["logistic_regression"]
    model = training.fit_model("logistic_regression", params, train, MODEL_ROLES)
    weighted, total = counts.with_class_weight(train, "label", "w")
    scaled = model.stages[0].transform(training.score_batch(model, weighted, MODEL_ROLES))
    slope = [F.sum(F.col("w") * (F.col("p") - F.col("label")) * F.col(c)) / total for c in MODEL_FEATURES]
    push = [float(b) / (params["C"] * total) for b in model.stages[-1].coefficients.toArray()]
    entries = [
        F.struct(F.lit(c).alias("feature"), F.round(F.abs(s + b), 3).alias("gradient"))
        for c, s, b in zip(MODEL_FEATURES, slope, push)
    ]
    return scaled.agg(F.array(*entries).alias("e")).select(F.inline("e"))


@query("final_evaluation")
def _final(spark, sf_dir) -> DataFrame:
    """Best family by validation F1, scored on test, attached to the raw rows, evaluated."""
    parts = prepared_splits(spark, sf_dir)
    models, table = training.compare_families(parts["train"], parts["val"], MODEL_ROLES, SETTINGS)
    best = training.best_model(table).first()["model"]
    predictions = training.score_batch(models[best], parts["test"], MODEL_ROLES)
    raw = parts["test"].drop("reading", "level")
    attached = materialize(temporal.attach_predictions(raw, predictions, ROLES), "final")
    return training.evaluate(attached.filter("yhat IS NOT NULL"), ROLES).select(
        F.lit(best).alias("model"), "*"
    )


@query("train_on_resampled")
def _resampled(spark, sf_dir) -> DataFrame:
    """The whole route: split, impute, balance the vectors of the training rows, fit, evaluate."""
    parts = prepared_splits(spark, sf_dir)
    train = pack(parts["train"], MODEL_FEATURES)
    # Read by every pass of the fit; written before, or each would search the neighbours again.
    balanced = materialize(unpack(smote_enn(train, clean_labels=[0, 1]), MODEL_FEATURES), "balanced")
    _, metrics = training.train_evaluate(
        "logistic_regression", SETTINGS["logistic_regression"], balanced, parts["val"], MODEL_ROLES
    )
    return metrics


@query("evaluation_report")
def _report(spark, sf_dir) -> DataFrame:
    df = scored(spark, sf_dir)
    train = prepared_splits(spark, sf_dir)["train"]
    model = training.fit_model("logistic_regression", SETTINGS["logistic_regression"], train, MODEL_ROLES)
    followed = ["reading", "level", "hour_of_day", "code", "p"]
    found = evaluation.evaluation_report(df, MODEL_ROLES, panel_groups(), followed, model)
    return evaluation.report_table(found)


_F1 = "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)"
_ACC = "CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)"


def _cells_sql(by: str, source: str = "scored") -> str:
    return f"""SELECT {by}, count(*) FILTER (label = 1 AND yhat = 1) AS tp, count(*) FILTER (label = 0 AND yhat = 1) AS fp,
  count(*) FILTER (label = 1 AND yhat = 0) AS fn, count(*) FILTER (label = 0 AND yhat = 0) AS tn,
  count(*) AS n, count(DISTINCT entity) AS e FROM {source} GROUP BY {by}"""


@query(
    "best_model",
    f"""WITH {PANEL_SQL}, c AS ({_cells_sql('kind')}),
m AS (SELECT kind, round(CAST({_F1} AS DOUBLE), 6) AS f1, row_number() OVER (ORDER BY kind) AS ord FROM c)
SELECT kind, f1 FROM m ORDER BY f1 DESC, ord LIMIT 1""",
)
def _best(spark, sf_dir) -> DataFrame:
    """Every event kind plays a model; ties go to the first by name."""
    table = r6(counts.classification_metrics(scored(spark, sf_dir), ROLES, ["kind"]))
    return training.best_model(table, "f1", "kind").select("kind", "f1")


_FOLDS_SQL = f"""{PANEL_SQL},
c AS (SELECT label, count(*) AS n, min(row_id) AS f FROM panel GROUP BY label),
o AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM c),
folds AS (SELECT label, i, (SELECT count(*) FROM range(CAST(o AS BIGINT), CAST(o + n AS BIGINT)) t(v) WHERE v % 5 <= i) AS upto
          FROM o, range(0, 4) r(i)),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_id) - 1 AS r FROM scored),
fs AS (SELECT rk.*, (SELECT count(*) FROM folds f WHERE f.label = rk.label AND rk.r >= f.upto) AS fold FROM rk)"""


@query(
    "cv_summary",
    f"""WITH {_FOLDS_SQL}, k AS ({_cells_sql('fold', 'fs')}),
m AS (SELECT CAST({_F1} AS DOUBLE) AS f1, {_ACC} AS accuracy,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall FROM k)
SELECT round(avg(f1), 6) AS mean_f1, round(avg(accuracy), 6) AS mean_accuracy, round(avg(precision), 6) AS mean_precision,
  round(avg(recall), 6) AS mean_recall, round(stddev_pop(f1), 6) AS f1_std FROM m""",
)
def _cv_summary(spark, sf_dir) -> DataFrame:
    df = scored(spark, sf_dir).select("row_id", "label", "yhat")
    folds = split.stratified_folds(df, ROLES, 5)
    per_fold = counts.classification_metrics(folds, ROLES, ["fold"])
    return r6(counts.cv_summary(per_fold, ["f1", "accuracy", "precision", "recall"]))


_TRIALS_SQL = f"""{PANEL_SQL}, c AS ({_cells_sql('day_no')}),
trials AS (SELECT CAST(day_no AS INTEGER) AS number, CASE WHEN tp + fn > 0 THEN 'COMPLETE' ELSE 'FAIL' END AS state,
  round(CAST({_F1} AS DOUBLE), 6) AS value, CAST(n AS VARCHAR) AS rows, CAST(e AS VARCHAR) AS entities FROM c)"""


def trials(spark, sf_dir) -> DataFrame:
    """Every day plays a trial: F1 of its rows, its size as parameters."""
    by_day = scored(spark, sf_dir).withColumn("number", F.col("day_no").cast("int"))
    f1 = r6(counts.classification_metrics(by_day, ROLES, ["number"]).select("number", F.col("f1").alias("value")))
    size = by_day.groupBy("number").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("entity").alias("entities"),
        F.max("label").alias("any"),
    )
    params = F.create_map(
        F.lit("rows"), F.col("rows").cast("string"), F.lit("entities"), F.col("entities").cast("string")
    )
    state = F.when(F.col("any") == 1, "COMPLETE").otherwise("FAIL")
    return f1.join(size, "number").select("number", state.alias("state"), "value", params.alias("params"))


@query(
    "trial_running_best",
    f"WITH {_TRIALS_SQL} SELECT number, value, max(value) OVER (ORDER BY number) AS best FROM trials",
)
def _running(spark, sf_dir) -> DataFrame:
    return trial_log.running_best(trials(spark, sf_dir))


@query(
    "trial_slice",
    f"""WITH {_TRIALS_SQL} SELECT number, value, 'rows' AS param, rows AS param_value FROM trials
UNION ALL SELECT number, value, 'entities', entities FROM trials""",
)
def _slice(spark, sf_dir) -> DataFrame:
    return trial_log.trial_slice(trials(spark, sf_dir))


@query("trial_state_counts", f"WITH {_TRIALS_SQL} SELECT state, count(*) AS n FROM trials GROUP BY state")
def _states(spark, sf_dir) -> DataFrame:
    return trial_log.state_counts(trials(spark, sf_dir))


@query(
    "trial_param_importance",
    f"""WITH {_TRIALS_SQL}, x AS (SELECT 'rows' AS param, CAST(rows AS DOUBLE) AS x, value FROM trials
  UNION ALL SELECT 'entities', CAST(entities AS DOUBLE), value FROM trials),
r AS (SELECT param, rank() OVER (PARTITION BY param ORDER BY x) + (count(*) OVER (PARTITION BY param, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY param ORDER BY value) + (count(*) OVER (PARTITION BY param, value) - 1) / 2.0 AS ry FROM x),
m AS (SELECT param, covar_pop(ry, rx) AS c, stddev_pop(rx) * stddev_pop(ry) AS s FROM r GROUP BY param)
SELECT param, 'numeric' AS kind, round(abs(c / nullif(s, 0)), 6) AS importance FROM m""",
)
def _param_importance(spark, sf_dir) -> DataFrame:
    return r6(trial_log.param_importance(trials(spark, sf_dir)))


@query(
    "trial_pair_grid",
    f"""WITH {_TRIALS_SQL}, x AS (SELECT CAST(rows AS DOUBLE) AS a, CAST(entities AS DOUBLE) AS b, value FROM trials),
s AS (SELECT *, min(a) OVER () AS la, max(a) OVER () AS ha, min(b) OVER () AS lb, max(b) OVER () AS hb FROM x),
g AS (SELECT CASE WHEN ha > la THEN CAST(CAST(least(floor((a - la) / ((ha - la) / 4)), 3) AS BIGINT) AS VARCHAR) ELSE '0' END AS cell_a,
             CASE WHEN hb > lb THEN CAST(CAST(least(floor((b - lb) / ((hb - lb) / 4)), 3) AS BIGINT) AS VARCHAR) ELSE '0' END AS cell_b, value FROM s)
SELECT cell_a, cell_b, count(*) AS n, round(avg(value), 6) AS mean_value, max(value) AS best_value FROM g GROUP BY 1, 2""",
)
def _grid(spark, sf_dir) -> DataFrame:
    return r6(trial_log.pair_grid(trials(spark, sf_dir), "rows", "entities", 4))


@query("trial_parallel_coordinates", f"WITH {_TRIALS_SQL} SELECT number, value, rows, entities FROM trials")
def _coordinates(spark, sf_dir) -> DataFrame:
    return trial_log.parallel_coordinates(trials(spark, sf_dir), ["rows", "entities"])


@query(
    "best_version",
    f"""WITH {PANEL_SQL}, c AS ({_cells_sql('kind, day_no')}),
m AS (SELECT kind AS key, CAST(day_no AS INTEGER) AS seq, round({_ACC}, 6) AS accuracy FROM c)
SELECT key, 'v' || (seq + 1) AS version, accuracy FROM m
QUALIFY row_number() OVER (PARTITION BY key ORDER BY accuracy DESC, seq) = 1""",
)
def _best_version(spark, sf_dir) -> DataFrame:
    """Every event kind plays a model, every day a version of it."""
    best = versions.best_version(_versions(spark, sf_dir), "accuracy")
    return best.select("key", "version", F.col("metrics")["accuracy"].alias("accuracy"))


@query(
    "latest_version",
    f"""WITH {PANEL_SQL}, c AS ({_cells_sql('kind, day_no')})
SELECT kind AS key, 'v' || (CAST(max(day_no) AS INTEGER) + 1) AS version FROM c GROUP BY kind""",
)
def _latest(spark, sf_dir) -> DataFrame:
    return versions.latest_version(_versions(spark, sf_dir)).select("key", "version")


def _versions(spark, sf_dir) -> DataFrame:
    by = r6(counts.classification_metrics(scored(spark, sf_dir), ROLES, ["kind", "day_no"]))
    seq = F.col("day_no").cast("int")
    return by.select(
        F.col("kind").alias("key"),
        seq.alias("seq"),
        F.concat(F.lit("v"), (seq + 1).cast("string")).alias("version"),
        F.create_map(F.lit("accuracy"), "accuracy").alias("metrics"),
    )


BOOST_FEATURES = ("level", "hour_of_day", "code")
BOOST = {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.3, "reg_alpha": 0.5, "reg_lambda": 0.7, "gamma": 0.1}


def _shrunk(g: str, h: str) -> str:
    return f"pow(greatest(abs({g}) - {BOOST['reg_alpha']}, 0), 2) / ({h} + {BOOST['reg_lambda']})"


def _level_sql(number: int) -> str:
    """Sums, options and best split of the nodes of a level, and the rows of the next."""
    at, to = f"l{number}", f"l{number + 1}"
    cells = " UNION ALL ".join(
        f"SELECT node, {j} AS feature, {c} AS x, sum(g) AS g, sum(h) AS h FROM {at} GROUP BY node, {c}" for j, c in enumerate(BOOST_FEATURES)
    )
    x = f"CASE s.feature {' '.join(f'WHEN {j} THEN r.{c}' for j, c in enumerate(BOOST_FEATURES))} END"
    return f"""
c{number} AS ({cells}),
t{number} AS (SELECT node, sum(g) AS tg, sum(h) AS th FROM {at} GROUP BY node),
u{number} AS (SELECT *, sum(g) FILTER (x IS NOT NULL) OVER w AS lg, sum(h) FILTER (x IS NOT NULL) OVER w AS lh,
  coalesce(sum(g) FILTER (x IS NULL) OVER p, 0) AS mg, coalesce(sum(h) FILTER (x IS NULL) OVER p, 0) AS mh FROM c{number}
  WINDOW p AS (PARTITION BY node, feature), w AS (PARTITION BY node, feature ORDER BY x NULLS LAST ROWS UNBOUNDED PRECEDING)),
o{number} AS (SELECT node, feature, x, miss, tg, th, lg + CASE WHEN miss THEN mg ELSE 0 END AS lg, lh + CASE WHEN miss THEN mh ELSE 0 END AS lh
  FROM u{number} JOIN t{number} USING (node), (VALUES (false), (true)) v(miss) WHERE x IS NOT NULL),
q{number} AS (SELECT *, round({_shrunk('lg', 'lh')} + {_shrunk('(tg - lg)', '(th - lh)')} - {_shrunk('tg', 'th')}, 9) AS gain
  FROM o{number} WHERE lh >= 1 AND th - lh >= 1),
s{number} AS (SELECT * FROM q{number} WHERE gain >= {BOOST['gamma']} AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, x, miss) = 1),
{to} AS (SELECT r.* EXCLUDE (node), 2 * r.node + CASE WHEN coalesce({x} <= s.x, s.miss) THEN 1 ELSE 2 END AS node
  FROM {at} r JOIN s{number} s USING (node))"""


_TREE_NODES = ", ".join(
    f"n{i} AS (SELECT t.node, s.feature, s.x, s.gain, tg, th FROM t{i} t LEFT JOIN (SELECT node, feature, x, gain FROM s{i}) s USING (node))"
    for i in (0, 1)
)


@query(
    "boosted_first_tree",
    f"""WITH {PANEL_SQL}, l0 AS (SELECT level, hour_of_day, code, 0.5 - label AS g, 0.25 AS h, 0 AS node FROM panel),
{_level_sql(0)}, {_level_sql(1)}, {_TREE_NODES},
n2 AS (SELECT node, NULL::INTEGER AS feature, NULL::DOUBLE AS x, NULL::DOUBLE AS gain, sum(g) AS tg, sum(h) AS th FROM l2 GROUP BY node),
nodes AS (SELECT * FROM n0 UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n2)
SELECT CASE feature {' '.join(f"WHEN {j} THEN '{c}'" for j, c in enumerate(BOOST_FEATURES))} END AS feature, CAST(x AS DOUBLE) AS threshold,
  round(CAST(gain AS DOUBLE), 4) AS gain, round(CAST(tg AS DOUBLE), 4) AS gradient, round(CAST(th AS DOUBLE), 4) AS curvature,
  round(CAST(-{BOOST['learning_rate']} * sign(tg) * greatest(abs(tg) - {BOOST['reg_alpha']}, 0) / (th + {BOOST['reg_lambda']}) AS DOUBLE), 6) AS value
FROM nodes""",
)
def _first_tree(spark, sf_dir) -> DataFrame:
    """Every node of the first tree boosted with penalties on its leaves."""
    df = panel(spark, sf_dir).select("row_id", "label", *BOOST_FEATURES)
    nodes = histogram_trees.fit_boosting(BOOST, df, BOOST_FEATURES, "label", "row_id", max_bins=4_096).nodes(spark)
    columns = [F.round(c, 4).alias(c) for c in ("gain", "gradient", "curvature")]
    return nodes.select("feature", "threshold", *columns, F.round("value", 6).alias("value"))


@query("train_penalised_boosting")
def _penalised(spark, sf_dir) -> DataFrame:
    """Boosting with penalties on leaves and gains, evaluated on the validation rows."""
    parts = prepared_splits(spark, sf_dir)
    params = BOOST | {"n_estimators": 20, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}
    _, metrics = training.train_evaluate("gradient_boosting", params, parts["train"], parts["val"], MODEL_ROLES)
    return metrics


@query("train_split_forest")
def _split_forest(spark, sf_dir) -> DataFrame:
    """A forest whose nodes need a number of rows to be split, evaluated on the validation rows."""
    parts = prepared_splits(spark, sf_dir)
    params = {"n_estimators": 30, "max_depth": 6, "min_samples_split": 8, "min_samples_leaf": 2, "max_features": "sqrt"}
    _, metrics = training.train_evaluate("random_forest", params, parts["train"], parts["val"], MODEL_ROLES)
    return metrics


GRID = [
    SETTINGS["logistic_regression"], {"C": 0.1, "penalty": "l2"}, {"C": 0.01, "penalty": "l1"},
    {"C": 0.05, "penalty": "elasticnet", "l1_ratio": 0.5},
]


@query("cross_validate_grid")
def _cv_grid(spark, sf_dir) -> DataFrame:
    """Four settings on five folds, fitted in the passes of one."""
    train = prepared_splits(spark, sf_dir)["train"]
    return logistic_grid.cross_validate_grid(GRID, train, MODEL_ROLES)


@query("search_grid")
def _search_grid(spark, sf_dir) -> DataFrame:
    """Eight drawn settings on five folds, fitted in the passes of one."""
    train = prepared_splits(spark, sf_dir)["train"]
    return logistic_grid.search_grid(train, MODEL_ROLES, 8)


@query("search_adaptive")
def _adaptive(spark, sf_dir) -> DataFrame:
    """Trials of a search that proposes from those before and stops poor ones on a third of the rows.

    The first ``STARTUP`` are drawn; as many again are proposed from what was found (20, the default of the reference).
    """
    train = prepared_splits(spark, sf_dir)["train"]
    path = f"{session_folder(spark)}/study-{uuid.uuid4().hex}"
    space = {"C": ("log", 0.001, 100.0), "max_iter": ("int", 20, 60)}
    return adaptive_search.search_family("logistic_regression", train, MODEL_ROLES, 2 * adaptive_search.STARTUP, path, k=2, shares=(1 / 3, 1.0), space=space)


@query("trial_variance_importance")
def _variance(spark, sf_dir) -> DataFrame:
    return trial_variance.variance_importance(trials(spark, sf_dir), trees=16)
