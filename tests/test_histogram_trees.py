from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from panelwise.plans import histogram_trees as trees
from panelwise.plans import training
from panelwise.roles import ColumnRoles

NAMES = ["a", "b", "c"]


def data(n=400, seed=0, gaps=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(1)
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=n) * 0.5 > 1).astype(int)
    if gaps:
        x[rng.random((n, 3)) < 0.1] = np.nan
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, int(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, label int, a double, b double, c double").repartition(parts)


def best_split(x, g, h, alpha, lam, gamma, least_h=1.0, least_n=1, least_split=2):
    """(gain, feature, threshold, missing left) of the best split, by trying all."""
    def score(a, b):
        return max(abs(a) - alpha, 0) ** 2 / (b + lam) if b + lam > 0 else 0.0

    found = None
    if len(g) < least_split:
        return None
    for j in range(x.shape[1]):
        for t in np.unique(x[~np.isnan(x[:, j]), j]):
            for miss in (False, True):
                left = np.where(np.isnan(x[:, j]), miss, x[:, j] <= t)
                gl, hl, nl = g[left].sum(), h[left].sum(), left.sum()
                gr, hr, nr = g.sum() - gl, h.sum() - hl, len(g) - nl
                if min(hl, hr) < least_h or min(nl, nr) < least_n:
                    continue
                gain = round(score(gl, hl) + score(gr, hr) - score(g.sum(), h.sum()), 9)
                if gain > 1e-9 and gain >= gamma and (found is None or (-gain, j, t, miss) < (-found[0], *found[1:])):
                    found = (gain, j, t, miss)
    return found


def grown(x, g, h, depth, rate, **rules):
    """(rows' values, number of nodes) of a tree grown by ``best_split``."""
    alpha, lam = rules["alpha"], rules["lam"]
    value = np.full(len(g), -rate * np.sign(g.sum()) * max(abs(g.sum()) - alpha, 0) / (h.sum() + lam))
    split = best_split(x, g, h, **rules) if depth else None
    if split is None:
        return value, 1
    _, j, t, miss = split
    left = np.where(np.isnan(x[:, j]), miss, x[:, j] <= t)
    nodes = 1
    for side in (left, ~left):
        value[side], more = grown(x[side], g[side], h[side], depth - 1, rate, **rules)
        nodes += more
    return value, nodes


@pytest.mark.parametrize("params", [
    {"reg_lambda": 1.0}, {"reg_alpha": 2.0, "reg_lambda": 0.3}, {"gamma": 6.0}, {"min_child_weight": 8.0, "max_depth": 4},
])
def test_boosted_trees_equal_all_splits_tried(spark, params):
    x, y = data()
    params = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.4} | params
    model = trees.fit_boosting(params, frame(spark, x, y), NAMES, "label", "row_id", max_bins=500)
    margin, nodes = np.zeros(len(y)), []
    for _ in range(3):
        p = 1 / (1 + np.exp(-margin))
        value, count = grown(
            x, p - y, p * (1 - p), params["max_depth"], 0.4, alpha=params.get("reg_alpha", 0.0), lam=params.get("reg_lambda", 1.0),
            gamma=params.get("gamma", 0.0), least_h=params.get("min_child_weight", 1.0),
        )
        margin += value
        nodes.append(count)
    assert [len(t.feature) for t in model.trees] == nodes
    rows = model.transform(frame(spark, x, y)).select("row_id", vector_to_array("probability")[1].alias("p")).orderBy("row_id").collect()
    assert np.allclose([r.p for r in rows], 1 / (1 + np.exp(-margin)), atol=1e-9)


def test_margins_written_between_trees_change_nothing(spark, monkeypatch):
    x, y = data(200)
    params = {"n_estimators": 5, "max_depth": 2, "subsample": 0.7, "colsample_bytree": 0.5}
    whole = trees.fit_boosting(params, frame(spark, x, y), NAMES, "label", "row_id")
    monkeypatch.setattr(trees, "TREES_KEPT", 2)
    parts = trees.fit_boosting(params, frame(spark, x, y, 5), NAMES, "label", "row_id")
    assert [t.feature for t in whole.trees] == [t.feature for t in parts.trees]
    assert np.allclose([v for t in whole.trees for v in t.value], [v for t in parts.trees for v in t.value])


def test_forest_without_drawing_equals_all_splits_tried(spark, monkeypatch):
    x, y = data(150)
    monkeypatch.setattr(trees, "_poisson", lambda u: np.ones(len(u)))
    monkeypatch.setattr(trees, "NODES_AT_ONCE", 3)
    params = {"n_estimators": 2, "max_depth": 4, "max_features": None, "min_samples_split": 20, "min_samples_leaf": 3}
    model = trees.fit_forest(params, frame(spark, x, y), NAMES, "label", max_bins=500)
    value, count = grown(x, -1.0 * y, np.ones(len(y)), 4, 1.0, alpha=0, lam=0, gamma=0, least_h=0, least_n=3, least_split=20)
    assert [len(t.feature) for t in model.trees] == [count, count]
    rows = model.transform(frame(spark, x, y)).select("row_id", vector_to_array("probability")[1].alias("p")).orderBy("row_id").collect()
    assert np.allclose([r.p for r in rows], value)
    nodes = model.nodes(spark).collect()
    assert all(n.rows >= 20 for n in nodes if n.feature) and all(n.rows >= 3 for n in nodes)


def test_families_take_the_parameters(spark):
    x, y = data(600, gaps=False)
    df, roles = frame(spark, x, y), ColumnRoles(entity="row_id").with_features(*NAMES)
    chosen = {"gradient_boosting": {"n_estimators": 8, "max_depth": 3, "reg_lambda": 1.0}, "random_forest": {"n_estimators": 10, "max_depth": 35, "min_samples_split": 4}}
    models, table = training.compare_families(df, df, roles, chosen)
    assert all(r["auc_roc"] > 0.9 for r in table.collect())
    for model in models.values():
        top = training.feature_importance(model, roles, spark).collect()
        assert {r["feature"] for r in top[:2]} == {"a", "b"}
    space = training.SEARCH_SPACES
    assert {"reg_alpha", "reg_lambda"} <= space["gradient_boosting"].keys() and "min_samples_split" in space["random_forest"]


def test_quantile_bins_and_odd_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(int(v > 0), float(v), 1.0, None) for v in rng.normal(size=3000)]
    df = spark.createDataFrame(rows, "label int, a double, same double, none double")
    edges = trees.bin_edges(df, ["a", "same", "none"], 32)
    assert 25 <= len(edges[0]) <= 31 and len(edges[1]) == len(edges[2]) == 0
    model = trees.fit_boosting({"n_estimators": 2, "max_depth": 2}, df, ["a", "same", "none"], "label", max_bins=32)
    assert {f for t in model.trees for f in t.feature} <= {-1, 0}
    empty = trees.fit_boosting({"n_estimators": 1}, df.limit(0), ["a"], "label")
    assert [t.feature for t in empty.trees] == [[-1]]


def test_rows_end_in_the_same_leaf_by_masks_and_by_steps(monkeypatch):
    rng, missing = np.random.default_rng(1), np.array([9, 9, 9])
    bins, tree = rng.integers(0, 10, (500, 3)), trees.Tree()
    for node in range(10):
        tree.split(node, int(rng.integers(3)), int(rng.integers(1, 8)), bool(rng.integers(2)), 1.0)
    found = []
    for most in (31, 0):
        monkeypatch.setattr(trees, "NODES_AS_MASKS", most)
        found.append(tree.leaf_of(bins, missing).tolist())
    assert found[0] == found[1] and len(set(found[0])) > 5
