from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelwise.operators.resample import pack, smote_enn, unpack
from panelwise.plans import evaluation, training
from panelwise.roles import ColumnRoles
from panelwise.sources import trial_log
from workload import queries_models

ROLES = ColumnRoles().with_features("a", "b")
SMALL = {
    "random_forest": {"n_estimators": 5, "max_depth": 30, "min_samples_leaf": 2, "max_features": None},
    "logistic_regression": {"C": 1.0, "penalty": "elasticnet", "l1_ratio": 0.3, "max_iter": 20},
    "gradient_boosting": {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3},
}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] + rng.normal(size=200) * 0.5 > 1.0).astype(int)
    data = [(i, f"e{i % 10}", i // 10, int(t), float(a), float(b)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "row_id long, entity string, hour int, label int, a double, b double")
    return df.coalesce(1).cache()


def test_families_beat_chance_and_keep_raw_columns(rows):
    models, table = training.compare_families(rows, rows, ROLES, SMALL)
    found = table.collect()
    assert [r["model"] for r in found] == list(SMALL)
    assert all(r["auc_roc"] > 0.8 for r in found)
    best = training.best_model(table).first()
    assert best["f1"] == max(r["f1"] for r in found)
    scored = training.score_batch(models["logistic_regression"], rows, ROLES)
    joined = scored.join(rows.select("row_id", rows["a"].alias("raw")), "row_id")
    assert joined.filter("a <> raw").count() == 0
    assert scored.filter("(p > 0.5) <> (yhat = 1)").count() == 0
    for family in ("random_forest", "logistic_regression"):
        top = training.feature_importance(models[family], ROLES, rows.sparkSession).collect()
        assert top[0]["feature"] == "a"


def test_saved_pipeline_scores_the_same(rows, tmp_path):
    model = training.fit_model("logistic_regression", SMALL["logistic_regression"], rows, ROLES)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a = training.score_batch(model, rows, ROLES).orderBy("row_id").collect()
    b = training.score_batch(again, rows, ROLES).orderBy("row_id").collect()
    assert [r["p"] for r in a] == [r["p"] for r in b]


def test_search_is_repeatable_and_keeps_failures(rows):
    space = {"C": ("log", 0.01, 1.0), "penalty": ("choice", ("l2", "wrong")), "max_iter": ("int", 5, 6)}
    assert training.draw_params("logistic_regression", 1, space=space) == training.draw_params(
        "logistic_regression", 1, space=space
    )
    numbers = {training.draw_params("logistic_regression", i, space=space)["penalty"]: i for i in range(8)}
    n = max(min(i for i in range(8) if training.draw_params("logistic_regression", i, space=space)["penalty"] == p)
            for p in numbers) + 1
    with pytest.warns(UserWarning, match="failed"):
        trials = training.search_trials("logistic_regression", rows, ROLES, n, k=2, space=space).cache()
    states = {r["state"]: r["n"] for r in trial_log.state_counts(trials).collect()}
    assert states["COMPLETE"] >= 1 and states["FAIL"] >= 1
    best = training.best_trial(trials).first()
    assert best["value"] == trials.agg({"value": "max"}).first()[0]


def test_every_fold_present_is_held_out(rows):
    folds = rows.withColumn("part", F.col("row_id") % 5)
    per_fold = training.cross_validate("logistic_regression", SMALL["logistic_regression"], folds, ROLES, fold_column="part")
    assert sorted(r["fold"] for r in per_fold.collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="5 folds"):
        training.cross_validate("logistic_regression", {}, folds, ROLES, k=3, fold_column="part")
    # A column named fold means nothing unless it is asked for.
    own = training.cross_validate("logistic_regression", SMALL["logistic_regression"], folds.withColumnRenamed("part", "other"), ROLES, k=2)
    assert own.count() == 2


def test_gamma_is_a_gain_of_all_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=4000)
    y = (x + rng.normal(size=4000) * 0.3 > 1.9).astype(int)
    df = spark.createDataFrame([(int(t), float(v)) for t, v in zip(y, x)], "label int, a double").coalesce(1)
    roles = ColumnRoles().with_features("a")
    model = training.fit_model("gradient_boosting", {"n_estimators": 2, "max_depth": 3, "gamma": 2.5}, df, roles)
    assert model.stages[-1].totalNumNodes > 2


@pytest.mark.parametrize("params", [{"max_depth": 31}, {"reg_alpha": 0.0}, {"reg_lambda": 1.0}])
def test_parameters_without_effect_are_refused(rows, params):
    with pytest.raises(ValueError):
        training.fit_model("random_forest", params, rows, ROLES)


def test_search_goes_on_where_it_stopped(rows, tmp_path, monkeypatch):
    space = {"C": ("log", 0.01, 1.0), "max_iter": ("int", 5, 6)}
    path = str(tmp_path / "trials")
    training.search_trials("logistic_regression", rows, ROLES, 1, k=2, space=space, path=path)
    ran = []
    real = training.cross_validate
    monkeypatch.setattr(training, "cross_validate", lambda *a, **b: ran.append(1) or real(*a, **b))
    trials = training.search_trials("logistic_regression", rows, ROLES, 3, k=2, space=space, path=path)
    assert len(ran) == 2 and sorted(r["number"] for r in trials.collect()) == [0, 1, 2]


def test_search_without_a_completed_trial_fails(rows):
    with pytest.warns(UserWarning), pytest.raises(RuntimeError):
        training.search_trials("logistic_regression", rows, ROLES, 1, k=2, space={"penalty": ("choice", ("wrong",))})


def test_conditional_parameter():
    for i in range(20):
        drawn = training.draw_params("logistic_regression", i)
        assert ("l1_ratio" in drawn) == (drawn["penalty"] == "elasticnet")
        assert 0.001 <= drawn["C"] <= 100 and 500 <= drawn["max_iter"] <= 1500


def test_resampling_stays_inside_the_fold(rows):
    seen = []

    def balance(train):
        seen.append(train.count())
        return unpack(smote_enn(pack(train, ["a", "b"]), clean_labels=[0]), ["a", "b"])

    per_fold = training.cross_validate(
        "logistic_regression", SMALL["logistic_regression"], rows, ROLES, k=2, resample=balance
    ).collect()
    assert sum(seen) == 200 and len(per_fold) == 2
    assert all(r["auc_roc"] > 0.7 for r in per_fold)


def test_report_has_every_analysis(rows):
    model = training.fit_model("random_forest", SMALL["random_forest"], rows, ROLES)
    scored = training.score_batch(model, rows, ROLES)
    report = evaluation.evaluation_report(
        scored, ROLES, {"low": F.col("a") < 0}, ["a", "b"], model=model
    )
    assert set(report) == {
        "metrics", "confusion", "confusion_normalized", "class_distribution", "areas", "roc_curve", "pr_curve",
        "calibration", "feature_importance", "missing", "temporal_progression", "group_errors", "interactions",
        "timeline",
    }
    table = evaluation.report_table(report).cache()
    sections = {r["section"] for r in table.select("section").distinct().collect()}
    assert sections == set(report)
    points = table.filter("section = 'roc_curve'").collect()
    rates = {(r["item"], r["measure"]): r["value"] for r in points}
    curve = report["roc_curve"].collect()
    assert len(rates) == len(points) == 2 * len(curve)
    assert all(rates[str(r["threshold"]).replace("inf", "Infinity"), "tpr"] == r["tpr"] for r in curve)


def test_balanced_rows_are_written_before_the_fit(spark, monkeypatch):
    names = queries_models.MODEL_FEATURES
    rows = [(i, int(i % 5 == 0), *(float((i * p) % 17 + 9 * (i % 5 == 0)) for p in (3, 5, 7, 11))) for i in range(120)]
    train = spark.createDataFrame(rows, f"row_id long, label int, {', '.join(f'{c} double' for c in names)}")
    monkeypatch.setattr(queries_models, "prepared_splits", lambda *_: {"train": train, "val": train})
    monkeypatch.setattr(training, "train_evaluate", lambda family, params, fitted, held_out, roles: (None, fitted))
    balanced = queries_models._resampled(spark, "nowhere")
    plan = balanced._jdf.queryExecution().toString()
    assert "Join" not in plan and "CoGroup" not in plan and balanced.count() > 120
