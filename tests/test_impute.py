from __future__ import annotations

import numpy as np
import pytest

from panelwise.operators import impute
from panelwise.operators.impute import ChainedImpute


def ridge_on_rows(x, y):
    """Evidence iteration on the rows themselves, through a singular value decomposition."""
    n = len(y)
    mx, my = x.mean(0), y.mean()
    xc, yc = x - mx, y - my
    u, s, vt = np.linalg.svd(xc, full_matrices=False)
    alpha, lam = 1.0 / (y.var() + np.finfo(float).eps), 1.0
    coef = None

    def solve():
        return vt.T @ (s / (s**2 + lam / alpha) * (u.T @ yc))

    for _ in range(300):
        new = solve()
        gamma = (alpha * s**2 / (lam + alpha * s**2)).sum()
        lam = (gamma + 2e-6) / ((new**2).sum() + 2e-6)
        alpha = (n - gamma + 2e-6) / (((yc - xc @ new) ** 2).sum() + 2e-6)
        if coef is not None and np.abs(coef - new).sum() < 1e-3:
            break
        coef = new
    coef = solve()
    return coef, my - mx @ coef


def chained_on_rows(x, rounds):
    """Round-robin imputation on the rows, one regression at a time."""
    x = x.copy()
    gone = np.isnan(x)
    x[gone] = np.broadcast_to(np.nanmean(x, axis=0), x.shape)[gone]
    order = [j for j in np.argsort(gone.mean(0), kind="stable") if gone[:, j].any()]
    for _ in range(rounds):
        for j in order:
            others = [i for i in range(x.shape[1]) if i != j]
            seen = ~gone[:, j]
            coef, intercept = ridge_on_rows(x[seen][:, others], x[seen, j])
            x[gone[:, j], j] = x[gone[:, j]][:, others] @ coef + intercept
    return x


@pytest.fixture(scope="module")
def holes():
    rng = np.random.default_rng(11)
    base = rng.normal(size=(180, 2))
    x = np.column_stack([base, base @ [1.0, -2.0] + 50, base @ [0.5, 3.0] - 7, rng.normal(size=180) * 4])
    x[:, 2:] += rng.normal(size=(180, 3)) * 0.2
    for j, share in ((1, 0.1), (2, 0.3), (3, 0.2)):
        x[rng.random(180) < share, j] = np.nan
    return x


def frame(spark, x):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id int, a double, b double, c double, d double, e double").repartition(3)


def values(df):
    return np.array([[r[c] for c in "abcde"] for r in df.orderBy("row_id").collect()])


@pytest.mark.parametrize("limit", [1 << 28, 0])
def test_matches_row_by_row_imputation(spark, holes, limit):
    df = frame(spark, holes)
    rounds = 3 if limit else 2
    model = ChainedImpute(list("abcde"), maxRounds=rounds, tol=0.0, maxDriverBytes=limit).fit(df)
    assert np.allclose(values(model.transform(df)), chained_on_rows(holes, rounds), atol=1e-6)


def test_full_task_hands_its_sums_on(spark, holes, monkeypatch):
    from panelwise.operators import impute

    monkeypatch.setattr(impute, "MAX_TASK_BYTES", 1)
    df = frame(spark, holes)
    model = ChainedImpute(list("abcde"), maxRounds=1, tol=0.0).fit(df)
    assert np.allclose(values(model.transform(df)), chained_on_rows(holes, 1), atol=1e-6)


def test_rounds_stop_when_nothing_moves(spark, holes):
    df = frame(spark, holes)
    model = ChainedImpute(list("abcde"), maxRounds=50, tol=1e-3).fit(df)
    assert 3 <= len(model.values()["fits"]) < 150
    assert np.allclose(values(model.transform(df)), chained_on_rows(holes, 50), atol=0.05)


def test_new_rows_are_filled_from_the_training_fit(spark, holes):
    df = frame(spark, holes)
    model = ChainedImpute(list("abcde"), maxRounds=3).fit(df)
    new = spark.createDataFrame([(0, 0.5, 0.1, None, None, None)], df.schema)
    row = model.transform(new).first()
    assert row["a"] == 0.5 and row["b"] == 0.1
    assert row["c"] == pytest.approx(50 + 0.5 - 0.2, abs=1.0)


def test_column_without_values_is_refused(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(ValueError):
        ChainedImpute(["a", "b"]).fit(df)


def test_rows_and_patterns_give_the_same(spark, holes, monkeypatch):
    df = frame(spark, holes)
    used = []
    real = impute._RowSums.__init__
    monkeypatch.setattr(impute._RowSums, "__init__", lambda self, *a: used.append(1) or real(self, *a))
    model = ChainedImpute(list("abcde"), maxRounds=2, tol=0.0, maxDriverBytes=0).fit(df)
    assert np.allclose(values(model.transform(df)), chained_on_rows(holes, 2), atol=1e-6)
    many = df.unionByName(df).unionByName(df).unionByName(df)
    shared = ChainedImpute(list("abcde"), maxRounds=2, tol=0.0, maxDriverBytes=0).fit(many)
    assert len(used) <= 2 and shared.rounds == 2 and not shared.converged


def test_rounds_end_when_nothing_moves(spark, holes):
    model = ChainedImpute(list("abcde")).fit(frame(spark, holes))
    assert model.converged and 1 < model.rounds < 200
