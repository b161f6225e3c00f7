from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.plans import logistic_grid as grid
from panelwise.plans import training
from panelwise.roles import ColumnRoles

ROLES = ColumnRoles().with_features("a", "b", "c")
SETTINGS = [
    {"C": 1.0, "penalty": "l2", "max_iter": 500, "tol": 1e-10},
    {"C": 0.02, "penalty": "l1", "max_iter": 500, "tol": 1e-10},
    {"C": 0.1, "penalty": "elasticnet", "l1_ratio": 0.4, "max_iter": 500, "tol": 1e-10},
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3)) * [1, 20, 0.1] + [0, 1000, 3]
    y = (x[:, 0] + (x[:, 1] - 1000) / 30 + rng.normal(size=500) > 0.7).astype(int)
    data = [(i, int(t), *map(float, r), i % 3) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "row_id long, label int, a double, b double, c double, part int").repartition(4)


def test_coefficients_are_those_of_separate_fits(rows):
    fitted = grid.fit_grid(rows.withColumnRenamed("part", "fold"), SETTINGS, ["a", "b", "c"], "label")
    assert set(fitted) == {(f, s) for f in range(3) for s in range(3)}
    for fold in (0, 2):
        for s, params in enumerate(SETTINGS):
            model = training.fit_model("logistic_regression", params, rows.filter(F.col("part") != fold), ROLES).stages[-1]
            *found, constant = fitted[fold, s][2]
            assert np.allclose(found, model.coefficients.toArray(), atol=2e-4) and abs(constant - model.intercept) < 2e-4


def test_metrics_are_those_of_cross_validation(rows):
    passes = []
    got = {(r["setting"], r["fold"]): r for r in grid.cross_validate_grid(SETTINGS, rows, ROLES, fold_column="part", passes=passes).collect()}
    assert len(got) == 9
    want = training.cross_validate("logistic_regression", SETTINGS[0], rows, ROLES, fold_column="part").collect()
    for r in want:
        assert all(abs(r[m] - got[0, r["fold"]][m]) < 1e-6 for m in training.CV_METRICS)
    assert passes[0] == 9 and len(passes) < 15


def test_passes_do_not_grow_with_models(rows, monkeypatch):
    one, many = [], []
    folds = rows.withColumnRenamed("part", "fold")
    grid.fit_grid(folds, SETTINGS[:1], ["a", "b", "c"], "label", one)
    grid.fit_grid(folds, SETTINGS[:1] * 8, ["a", "b", "c"], "label", many)
    assert len(one) == len(many)
    monkeypatch.setattr(grid, "MOST_SUMS", 50)
    grouped = grid.fit_grid(folds, SETTINGS, ["a", "b", "c"], "label")
    whole = grid.fit_grid(folds, SETTINGS, ["a", "b", "c"], "label")
    assert all(m in whole for m in grouped) and len(whole) == 9


def test_constant_feature_and_separable_rows(spark):
    data = [(i, int(i >= 20), float(i), 1.0, i % 2) for i in range(40)]
    df = spark.createDataFrame(data, "row_id long, label int, a double, b double, fold int")
    fitted = grid.fit_grid(df, [{"C": 1.0}], ["a", "b"], "label")
    for _, _, w in fitted.values():
        assert np.isfinite(w).all() and w[0] > 0 and abs(w[1]) < 1e-6
    with pytest.raises(ValueError):
        grid.fit_grid(df, [{"reg_lambda": 1.0}], ["a", "b"], "label")


def test_search_gives_the_trials_of_separate_fits(rows):
    space = {"C": ("log", 0.05, 5.0), "penalty": ("choice", ("l2", "l1")), "max_iter": ("int", 300, 400), "tol": ("float", 1e-9, 1e-8)}
    got = {r["number"]: r for r in grid.search_grid(rows.drop("part"), ROLES, 2, k=3, space=space).collect()}
    want = {r["number"]: r for r in training.search_trials("logistic_regression", rows.drop("part"), ROLES, 2, k=3, space=space).collect()}
    assert got.keys() == want.keys()
    for number, r in want.items():
        assert got[number]["params"] == r["params"] and got[number]["state"] == "COMPLETE"
        assert all(abs(got[number][m] - r[m]) < 1e-6 for m in ("value", "accuracy", "roc_auc", "precision", "recall", "f1_std"))
    wrong = {"penalty": ("choice", ("none of these", "l2"))}
    states = {r["state"] for r in grid.search_grid(rows.drop("part"), ROLES, 8, k=2, space=wrong).collect()}
    assert states == {"FAIL", "COMPLETE"}
    with pytest.raises(RuntimeError):
        grid.search_grid(rows.drop("part"), ROLES, 2, k=2, space={"penalty": ("choice", ("wrong",))})
