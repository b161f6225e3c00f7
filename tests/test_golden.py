"""Trial logs and versions as earlier runs of such a search have left them."""

from __future__ import annotations

import json

from panelwise.sources import registry, trial_log

# The first trials of one finished search.
TRIALS = """number,value,f1_score,accuracy,roc_auc,precision,recall,f1_std,cv_iteration,params
0,0.8603240349831736,0.8603240349831736,0.896470011776235,0.9715998922026644,0.7989991127780112,0.9366078470081624,0.04146445122590208,1,"{'n_estimators': 119, 'max_depth': 10, 'min_samples_split': 10, 'min_samples_leaf': 5, 'max_features': 'sqrt'}"
1,0.7787185589516415,0.7787185589516415,0.8296913473495234,0.9260219303163079,0.703901325649039,0.8791696955302847,0.04645166086880962,2,"{'n_estimators': 397, 'max_depth': 7, 'min_samples_split': 3, 'min_samples_leaf': 4, 'max_features': 'log2'}"
2,0.9779732330557049,0.9779732330557049,0.9849358895175038,0.9995360157193761,0.9614156448313325,0.9953835012867027,0.01050019979034067,3,"{'n_estimators': 305, 'max_depth': 23, 'min_samples_split': 3, 'min_samples_leaf': 4, 'max_features': 'log2'}"
3,0.8511681227564836,0.8511681227564836,0.8907373323121773,0.9595847660176681,0.7958568742606799,0.9190879248743569,0.04212304989288653,4,"{'n_estimators': 492, 'max_depth': 9, 'min_samples_split': 5, 'min_samples_leaf': 4, 'max_features': None}"
4,0.9774998471953364,0.9774998471953364,0.9845951610379556,0.9994996564807672,0.9609054781532439,0.9949982786489663,0.01157842645493068,5,"{'n_estimators': 412, 'max_depth': 18, 'min_samples_split': 4, 'min_samples_leaf': 1, 'max_features': 'sqrt'}"
5,0.9808680524249894,0.9808680524249894,0.9869699664830233,0.9996399998454506,0.9668580504243144,0.9954790365111187,0.008547331534658337,6,"{'n_estimators': 300, 'max_depth': 27, 'min_samples_split': 7, 'min_samples_leaf': 3, 'max_features': 'sqrt'}"
"""

# Versions, time stamps, F1 and accuracy of two registered models.
VERSIONS = {
    "Random Forest (Tuned)": [
        ("v1", "20241214_152025", 0.5551061678463094, 0.9873042437008129),
        ("v2", "20241214_175227", 0.5548612846788303, 0.9871527602449703),
        ("v3", "20241215_042816", 0.5655375552282769, 0.9872321087218403),
    ],
    "XGBoost (Tuned)": [
        ("v1", "20241215_014011", 0.3308887724812293, 0.9447157521153583),
        ("v2", "20241215_110337", 0.2761625830416458, 0.9269056258070101),
        ("v3", "20241215_134511", 0.25915343212173564, 0.9195767119433884),
    ],
}


def test_trials_of_a_finished_search(spark, tmp_path):
    (tmp_path / "trials.csv").write_text(TRIALS)
    log = trial_log.read_trial_log(spark, str(tmp_path / "trials.csv"))
    rows = {r["number"]: r for r in log.collect()}
    assert len(rows) == 6 and rows[5]["roc_auc"] == 0.9996399998454506 and rows[3]["cv_iteration"] == 4
    assert rows[3]["params"] == {
        "n_estimators": "492", "max_depth": "9", "min_samples_split": "5", "min_samples_leaf": "4", "max_features": None,
    }
    best = {r["number"]: r["best"] for r in trial_log.running_best(log).collect()}
    assert [best[i] for i in range(6)] == [
        0.8603240349831736, 0.8603240349831736, 0.9779732330557049, 0.9779732330557049, 0.9779732330557049, 0.9808680524249894,
    ]
    sliced = trial_log.trial_slice(log)
    depths = {r["number"]: r["param_value"] for r in sliced.filter("param = 'max_depth'").collect()}
    assert sliced.count() == 30 and depths == {0: "10", 1: "7", 2: "23", 3: "9", 4: "18", 5: "27"}


def test_versions_of_registered_models(spark, tmp_path):
    document = {
        "models": {
            name: [
                {"name": name, "version": v, "timestamp": t, "metrics": {"F1 Score": f1, "Accuracy": accuracy},
                 "params": {"random_state": 42}, "tags": [], "model_path": f"/models/{v}", "artifacts": {}}
                for v, t, f1, accuracy in versions
            ]
            for name, versions in VERSIONS.items()
        }
    }
    (tmp_path / "versions.json").write_text(json.dumps(document, indent=4))
    rows = registry.read_registry_json(spark, str(tmp_path / "versions.json"))
    listed = {(r["key"], r["version"]): r["timestamp"] for r in rows.collect()}
    assert listed == {(name, v): t for name, versions in VERSIONS.items() for v, t, _, _ in versions}
    latest = {r["key"]: r["version"] for r in registry.latest_version(rows).collect()}
    assert latest == {"Random Forest (Tuned)": "v3", "XGBoost (Tuned)": "v3"}
    best = {m: {r["key"]: r["version"] for r in registry.best_version(rows, m).collect()} for m in ("F1 Score", "Accuracy")}
    assert best["F1 Score"] == {"Random Forest (Tuned)": "v3", "XGBoost (Tuned)": "v1"}
    assert best["Accuracy"] == {"Random Forest (Tuned)": "v1", "XGBoost (Tuned)": "v1"}
