from __future__ import annotations

import numpy as np
import pytest

from panelwise.operators import split
from panelwise.plans import adaptive_search as study
from panelwise.plans import training
from panelwise.roles import ColumnRoles
from panelwise.sources import trial_log
from workload import queries_models

SPACE = {"x": ("float", -5.0, 5.0), "c": ("log", 1e-3, 1e2), "n": ("int", 1, 9), "kind": ("choice", ("a", "b", None))}


def planted(p):
    """Largest, 0, at x = 2, c = 0.1, n = 6, kind b."""
    return -((p["x"] - 2) ** 2) / 10 - abs(np.log10(p["c"]) + 1) / 3 - abs(p["n"] - 6) / 9 - (p["kind"] != "b")


def simulated(propose, n, seed):
    trials, best = [], -np.inf
    for number in range(n):
        params = propose(trials, number, seed)
        value = planted(params)
        best = max(best, value)
        text = {k: None if v is None else str(v) for k, v in params.items()}
        trials.append({"number": number, "state": "COMPLETE", "value": value, "params": text, "steps": []})
    return best, trials


def test_proposals_beat_random_draws():
    def adaptive(trials, number, seed):
        return study.propose(trials, SPACE, number, seed)

    def drawn(trials, number, seed):
        return training.draw_params("logistic_regression", number, seed, SPACE)

    pairs = [(simulated(adaptive, 60, s)[0], simulated(drawn, 60, s)[0]) for s in range(8)]
    assert sum(a > b for a, b in pairs) >= 6 and np.mean([a for a, _ in pairs]) > np.mean([b for _, b in pairs]) / 2


def test_the_same_table_gives_the_same_proposal():
    _, trials = simulated(lambda t, n, s: study.propose(t, SPACE, n, s), 30, 1)
    again = study.propose(list(reversed(trials)), SPACE, 30, 1)
    assert again == study.propose(trials, SPACE, 30, 1) and again != study.propose(trials, SPACE, 30, 2)
    assert -5 <= again["x"] <= 5 and 1e-3 <= again["c"] <= 1e2 and again["n"] in range(1, 10) and again["kind"] in ("a", "b", None)


def test_conditional_parameters_only_where_they_apply():
    space = training.SEARCH_SPACES["logistic_regression"]
    _, trials = [], []
    for number in range(40):
        p = study.propose(trials, space, number, 3)
        assert ("l1_ratio" in p) == (p["penalty"] == "elasticnet")
        text = {k: str(v) for k, v in p.items()}
        trials.append({"number": number, "state": "COMPLETE", "value": p["C"], "params": text, "steps": []})


def test_rules():
    halving, median = study.halving_rule(3), study.median_rule(2, 1)
    earlier = [[0.5, 0.6], [0.4], [0.3], [0.2, 0.1]]
    assert not halving(0, 0.45, earlier) and halving(0, 0.35, earlier) and not halving(1, 0.7, earlier)
    assert not median(0, 0.0, earlier) and median(1, 0.2, earlier) and not median(1, 0.4, earlier) and not median(1, 0.2, earlier[:1])


def test_study_prunes_resumes_and_keeps_the_best(spark, tmp_path):
    seen = []

    def objective(params, report):
        seen.append(params)
        value = planted(params)
        for step in range(3):
            report(step, value - (3 - step) / 10)
        if params["n"] == 1:
            raise ValueError("refused")
        return value, {"f1": value}

    path = str(tmp_path / "study")
    study.run_study(spark, objective, SPACE, 12, path, rule=study.halving_rule(3))
    with pytest.raises(FileExistsError):
        study.run_study(spark, objective, SPACE, 1, path, load_if_exists=False)
    trials = study.run_study(spark, objective, SPACE, 12, path, rule=study.halving_rule(3)).collect()
    whole = study.run_study(spark, objective, SPACE, 24, str(tmp_path / "one"), rule=study.halving_rule(3)).collect()
    assert sorted(trials) == sorted(whole) and len(seen) == 48
    states = {r["state"]: r["n"] for r in trial_log.state_counts(spark.read.parquet(path)).collect()}
    assert states["PRUNED"] >= 6 and states["COMPLETE"] >= 2
    values = {r["number"]: planted(p) for r, p in zip(sorted(trials), seen[:24])}
    finished = {r["number"] for r in trials if r["state"] != "PRUNED"}
    assert max(values, key=values.get) in finished
    assert all(len(r["steps"]) < 4 for r in trials)
    best = training.best_trial(spark.read.parquet(path)).first()
    assert best["value"] == max(r["value"] for r in trials if r["state"] == "COMPLETE")


def test_family_study(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] + rng.normal(size=400) * 0.3 > 0.5).astype(int)
    df = spark.createDataFrame([(i, int(t), float(a), float(b)) for i, ((a, b), t) in enumerate(zip(x, y))], "row_id long, label int, a double, b double")
    roles = ColumnRoles().with_features("a", "b")
    space = {"C": ("log", 1e-6, 10.0), "max_iter": ("int", 5, 9)}
    trials = study.search_family("logistic_regression", df, roles, 4, str(tmp_path / "s"), k=2, shares=(0.4, 1.0), space=space).collect()
    assert [r["number"] for r in sorted(trials)] == [0, 1, 2, 3]
    assert {r["state"] for r in trials} <= {"COMPLETE", "PRUNED"} and all(len(r["steps"]) == 1 for r in trials)
    assert max(r["value"] or 0 for r in trials) > 0.7


def test_folds_are_made_once_per_share(spark, tmp_path, monkeypatch):
    made = []

    def counted(*args):
        made.append(args)
        return split.stratified_folds(*args)

    monkeypatch.setattr(training, "stratified_folds", counted)
    monkeypatch.setattr(study, "stratified_folds", counted, raising=False)
    df = spark.range(120).selectExpr("id AS row_id", "concat('e', id % 7) AS entity", "cast(id % 3 = 0 AS int) AS label", "id % 3 + 0.1 * (id % 5) AS a")
    space = {"C": ("log", 0.01, 1.0), "max_iter": ("int", 5, 6)}
    roles = ColumnRoles().with_features("a")
    found = study.search_family("logistic_regression", df, roles, 2, str(tmp_path / "s"), k=2, shares=(0.5, 1.0), rule=lambda *_: False, space=space)
    assert [r["state"] for r in found.collect()] == ["COMPLETE"] * 2
    assert len(made) == 2


def test_the_query_proposes_from_earlier_trials(monkeypatch):
    asked = {}

    def noted(family, df, roles, n_trials, path, **options):
        asked.update(options, n_trials=n_trials)

    monkeypatch.setattr(queries_models, "prepared_splits", lambda *_: {"train": None})
    monkeypatch.setattr(queries_models, "session_folder", lambda _: "nowhere")
    monkeypatch.setattr(study, "search_family", noted)
    queries_models._adaptive(None, "nowhere")

    def proposals(value):
        trials, space = [], asked["space"]
        for number in range(asked["n_trials"]):
            params = study.propose(trials, space, number)
            text = {k: str(v) for k, v in params.items()}
            trials.append({"number": number, "state": "COMPLETE", "value": value(params), "params": text, "steps": []})
        return [t["params"] for t in trials]

    small, large = proposals(lambda p: -p["C"]), proposals(lambda p: p["C"])
    assert small[: study.STARTUP] == large[: study.STARTUP]
    assert all(a != b for a, b in zip(small[study.STARTUP :], large[study.STARTUP :])) and len(small) > study.STARTUP
