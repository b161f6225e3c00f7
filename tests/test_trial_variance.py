from __future__ import annotations

import itertools

import numpy as np
import pytest

from panelwise.plans import histogram_trees, trial_variance

LEVELS = {"a": [1.0, 2.0, 3.0, 4.0], "b": [10, 20, 30], "kind": ["x", "y", None]}


def grid(spark, f, drop=()):
    rows = []
    for i, (a, b, kind) in enumerate(itertools.product(*LEVELS.values())):
        rows.append((i, None if i in drop else float(f(a, b, kind)), {"a": str(a), "b": str(b), "kind": kind}))
    return spark.createDataFrame(rows, "number int, value double, params map<string,string>")


def brute(f):
    """Share of variance of the mean along each parameter of a full grid."""
    table = np.array([[[f(a, b, k) for k in LEVELS["kind"]] for b in LEVELS["b"]] for a in LEVELS["a"]], float)
    out = {}
    for axis, name in enumerate(LEVELS):
        others = tuple(x for x in range(3) if x != axis)
        out[name] = table.mean(axis=others).var() / table.var()
    return out


@pytest.mark.parametrize("f", [
    lambda a, b, k: a + 0.1 * b + 3 * (k == "x"), lambda a, b, k: a * b * (2 if k is None else 1), lambda a, b, k: -((a - 2) ** 2) + (k == "y") * b,
])
def test_shares_of_a_full_grid_equal_brute_force(spark, monkeypatch, f):
    monkeypatch.setattr(histogram_trees, "_poisson", lambda u: np.ones(len(u)))
    got = {r["param"]: r["importance"] for r in trial_variance.variance_importance(grid(spark, f), trees=2).collect()}
    want = brute(f)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in want)


def test_drawn_forest_ranks_parameters_and_takes_a_space(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(150):
        c, n, u = 10 ** rng.uniform(-3, 2), int(rng.integers(1, 10)), rng.uniform()
        rows.append((i, float(np.log10(c) * 3 + n * 0.4), {"c": str(c), "n": str(n), "u": str(u)}))
    trials = spark.createDataFrame(rows, "number int, value double, params map<string,string>")
    space = {"c": ("log", 1e-3, 1e2), "n": ("int", 1, 9), "u": ("float", 0.0, 1.0)}
    got = {r["param"]: r["importance"] for r in trial_variance.variance_importance(trials, space, trees=12).collect()}
    assert got["c"] > 0.75 > got["n"] > 0.02 > got["u"] and sum(got.values()) <= 1 + 1e-9


def test_odd_tables(spark):
    flat = {r["param"]: r["importance"] for r in trial_variance.variance_importance(grid(spark, lambda a, b, k: 1.0, drop=(0, 5)), trees=2).collect()}
    assert flat == {"a": 0.0, "b": 0.0, "kind": 0.0}
    assert trial_variance.variance_importance(grid(spark, lambda a, b, k: a).limit(0)).count() == 0
