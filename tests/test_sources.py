from __future__ import annotations

import json

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from panelwise.functions import scalar
from panelwise.operators import stages
from panelwise.roles import ColumnRoles
from panelwise.sources import panel as source
from panelwise.sources import registry, sinks, trial_log

ROLES = ColumnRoles()
SCHEMA = "entity string, hour int, label int, x double"


def write_csv(path, rows):
    path.write_text("entity,hour,label,x\n" + "\n".join(rows) + "\n")
    return str(path)


def test_load_panel_checks(spark, tmp_path):
    good = write_csv(tmp_path / "good.csv", ["1,0,0,2.5", "1,1,1,NaN", "2,0,0,"])
    df = source.load_panel(spark, good, SCHEMA, ROLES)
    assert sorted((r["entity"], r["x"] is None) for r in df.collect()) == [("1", False), ("1", True), ("2", True)]
    with pytest.raises(FileNotFoundError):
        source.load_panel(spark, str(tmp_path / "none.csv"), SCHEMA, ROLES)
    bad = write_csv(tmp_path / "bad.csv", ["1,0,0,1", "1,1,1,1", "2,0,2,1"])
    with pytest.raises(ValueError, match="two values"):
        source.load_panel(spark, bad, SCHEMA, ROLES)
    with pytest.raises(ValueError, match="missing required"):
        source.load_panel(spark, good, SCHEMA, ColumnRoles(entity="who"))


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "odd.csv").write_text("x,extra,label,entity,hour\n2.5,q,1,7,3\n")
    row = source.load_panel(spark, str(tmp_path / "odd.csv"), SCHEMA, ROLES).first()
    assert row.asDict() == {"entity": "7", "hour": 3, "label": 1, "x": 2.5}
    with pytest.raises(ValueError, match="missing required"):
        source.load_panel(spark, str(tmp_path / "odd.csv"), SCHEMA + ", y double", ROLES)


def test_splits_round_trip(spark, tmp_path):
    rows = [("a", 0, 0, 1.0, "train"), ("b", 0, 1, 2.0, "val"), ("c", 0, 0, 3.0, "test")]
    tagged = spark.createDataFrame(rows, SCHEMA + ", split string")
    root = str(tmp_path / "splits")
    source.write_splits(tagged, root, "csv")
    paths = {s: f"{root}/split={s}" for s in ("train", "val", "test")}
    back = source.load_splits(spark, paths, SCHEMA, ROLES)
    assert {(r["entity"], r["split"]) for r in back.collect()} == {("a", "train"), ("b", "val"), ("c", "test")}
    with pytest.raises(ValueError, match="more than one split"):
        source.load_splits(spark, {"train": paths["train"], "val": paths["train"]}, SCHEMA, ROLES)
    other = tmp_path / "other.csv"
    other.write_text("entity,hour,label\nz,0,0\n")
    with pytest.raises(ValueError, match="mismatch"):
        source.load_splits(spark, {"train": paths["train"], "val": str(other)}, SCHEMA, ROLES)


def test_stage_is_built_once_per_configuration(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for config in ({"a": 1}, {"a": 1}, {"a": 2}):
        assert source.stage_table(spark, str(tmp_path), "s", config, build).count() == 3
    assert len(built) == 2


def test_metric_and_parameter_tables(spark, tmp_path):
    path = str(tmp_path / "metrics")
    sinks.save_metrics(spark, {"f1": 0.5, "auc": None}, "m", "r1", path)
    sinks.save_metrics(spark, {"f1": 0.7}, "m", "r2", path)
    got = {r["run_id"]: r["metrics"] for r in sinks.read_metrics(spark, path).collect()}
    assert got == {"r1": {"f1": 0.5, "auc": None}, "r2": {"f1": 0.7}}
    sinks.save_hyperparameters(spark, {"C": 1.0, "max_features": None}, "m", "r1", str(tmp_path / "p"), "json")
    assert spark.read.json(str(tmp_path / "p")).first()["params"]["C"] == "1.0"


def test_trial_log(spark, tmp_path):
    text = (
        "number,value,f1_score,accuracy,roc_auc,precision,recall,f1_std,cv_iteration,params\n"
        "0,0.5,0.5,0.9,0.8,0.4,0.6,0.01,1,\"{'depth': 5, 'features': None, 'kind': 'a'}\"\n"
        "2,0.4,0.4,0.9,0.8,0.4,0.6,0.01,2,\"{'depth': 9, 'features': 'log2', 'kind': 'b'}\"\n"
        "3,0.7,0.7,0.9,0.8,0.4,0.6,0.01,3,\"{'depth': 7, 'features': 'sqrt', 'kind': 'a'}\"\n"
    )
    (tmp_path / "t.csv").write_text(text)
    log = trial_log.read_trial_log(spark, str(tmp_path / "t.csv"))
    assert log.filter("params IS NULL").count() == 0
    assert {r["number"]: r["best"] for r in trial_log.running_best(log).collect()} == {0: 0.5, 2: 0.5, 3: 0.7}
    assert trial_log.trial_slice(log).count() == 9
    kinds = {r["param"]: (r["kind"], r["importance"]) for r in trial_log.param_importance(log).collect()}
    assert kinds["depth"] == ("numeric", pytest.approx(0.5))
    assert kinds["kind"][0] == "category" and 0 < kinds["kind"][1] <= 1
    wide = trial_log.parallel_coordinates(log, ["depth", "kind"]).orderBy("number").collect()
    assert [(r["depth"], r["kind"]) for r in wide] == [("5", "a"), ("9", "b"), ("7", "a")]
    grid = {(r["cell_a"], r["cell_b"]): r["n"] for r in trial_log.pair_grid(log, "depth", "kind", 2).collect()}
    assert grid == {("0", "a"): 1, ("1", "b"): 1, ("1", "a"): 1}
    trial_log.write_trial_log(log, str(tmp_path / "table"), "study")
    assert spark.read.parquet(str(tmp_path / "table")).filter("study = 'study'").count() == 3


def test_names_and_run_times(spark):
    df = spark.createDataFrame([('a<b>:c"/\\|?*d e', "20241215_010515")], "n string, t string")
    row = df.select(
        scalar.sanitize_name(F.col("n")), scalar.slug(F.col("n")), scalar.run_time(F.col("t")).cast("string")
    ).first()
    assert row[0] == "a_b__c______d e"
    assert row[1].endswith("d_e")
    assert row[2] == "2024-12-15 01:05:15"


def small_model(spark, value):
    df = spark.createDataFrame([(value,), (value + 2,)], "x double")
    return Pipeline(stages=[stages.StandardScale(["x"])]).fit(df)


def test_registry_life_cycle(spark, tmp_path):
    reg = registry.ModelRegistry(spark, str(tmp_path / "reg"))
    with pytest.raises(ValueError, match="not found"):
        reg.load_model("m: 1")
    for i, f1 in enumerate((0.5, 0.9, 0.9)):
        row = reg.save_model(small_model(spark, float(i)), "m: 1", {"C": i, "k": None}, {"f1": f1}, tags=["t"])
        assert row["version"] == f"v{i + 1}" and row["key"] == "m_ 1"
    assert reg.list_models().first()["latest"] == "v3"
    model, row = reg.load_model("m: 1", "v1")
    assert row["metrics"] == {"f1": 0.5}
    assert model.transform(spark.createDataFrame([(1.0,)], "x double")).first()["x"] == 0.0
    assert reg.best_model("m: 1", "f1")[1]["version"] == "v2"
    assert reg.best_model("m: 1", "f1", higher_is_better=False)[1]["version"] == "v1"
    with pytest.raises(ValueError, match="has auc"):
        reg.best_model("m: 1", "auc")
    with pytest.raises(ValueError, match="v9"):
        reg.load_model("m: 1", "v9")
    reg.delete_model("m: 1", "v3")
    assert reg.load_model("m: 1")[1]["version"] == "v2"
    again = reg.save_model(small_model(spark, 1.0), "m: 1", {}, {"f1": 0.1})
    assert again["version"] == "v4"  # a number is never used twice
    reg.delete_model("m: 1")
    assert reg.list_models().count() == 0


def test_registry_document_with_bare_nan(spark, tmp_path):
    def version(v, f1):
        return {"name": "A B", "version": v, "timestamp": "20241215_010515", "metrics": {"F1": f1},
                "params": {"depth": 3, "features": None, "miss": float("nan")}, "tags": ["x"],
                "model_path": "/p", "artifacts": {}}

    doc = {"models": {"A B": [version("v1", 0.4), version("v2", 0.6), version("v3", 0.6)], "C": [version("v1", 0.2)]}}
    (tmp_path / "r.json").write_text(json.dumps(doc, indent=2))
    rows = registry.read_registry_json(spark, str(tmp_path / "r.json"))
    assert rows.count() == 4
    best = {r["key"]: r["version"] for r in registry.best_version(rows, "F1").collect()}
    assert best == {"A B": "v2", "C": "v1"}
    last = {r["key"]: r["version"] for r in registry.latest_version(rows).collect()}
    assert last == {"A B": "v3", "C": "v1"}


def test_scratch_is_empty_after_it_is_dropped(spark):
    import os

    from panelwise import session

    kept = session.materialize(spark.range(5).toDF("n"), "some")
    assert kept.count() == 5 and os.listdir(session.session_folder(spark))
    session.drop_scratch(spark)
    assert not os.path.exists(session.session_folder(spark))


def test_executors_find_the_package_from_any_folder(tmp_path):
    """A session started elsewhere, with the package on the driver's path alone."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from panelwise.session import tune
from panelwise.operators.neighbours import nearest_neighbours
tune(spark)
rows = [(i, [float(i), 0.0]) for i in range(9)]
df = spark.createDataFrame(rows, "row_id long, vec array<double>")
print("ROWS", nearest_neighbours(df, 2).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 9" in done.stdout, done.stderr[-2000:]


def test_two_writers_never_share_a_version_number(spark, tmp_path):
    from panelwise.session import create_file

    path = f"{tmp_path}/claims/model/1"
    assert create_file(spark, path) and not create_file(spark, path)


def test_changed_input_makes_a_new_stage_table(spark, tmp_path):
    from panelwise.sources.panel import stage_table

    source, root = f"{tmp_path}/in", f"{tmp_path}/out"

    def built():
        return spark.read.parquet(source)

    spark.range(3).write.parquet(source)
    assert stage_table(spark, root, "s", {"a": 1}, built, [source]).count() == 3
    assert stage_table(spark, root, "s", {"a": 1}, built, [source]).count() == 3
    spark.range(2).write.mode("append").parquet(source)
    assert stage_table(spark, root, "s", {"a": 1}, built, [source]).count() == 5


def test_a_cell_of_the_wrong_type_ends_the_read(spark, tmp_path):
    from panelwise.roles import ColumnRoles
    from panelwise.sources.panel import load_panel

    path = tmp_path / "p.csv"
    path.write_text("row_id,entity,hour,label,a\n1,e,0,0,1.5\n2,e,1,0,bad\n")
    with pytest.raises(Exception):
        load_panel(spark, str(path), "row_id long, entity string, hour int, label int, a double", ColumnRoles()).collect()
