from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from panelwise.operators import columns as cols
from panelwise.operators import split, stages, validate
from panelwise.operators.quantiles import approximate_quantiles, exact_quantiles
from panelwise.plans.preprocess import Preparation, clinical_preparation, preprocess
from panelwise.roles import ColumnRoles

ROLES = ColumnRoles()


def test_exact_quantiles_narrow_down(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=5000)
    b = np.where(rng.random(5000) < 0.4, 7.0, np.round(rng.random(5000) * 20, 1))  # one hot value
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for limit in (20, 1_000_000):
        got = exact_quantiles(df, ["a", "b"], probs, max_sorted=limit)
        assert got["a"] == pytest.approx(list(np.quantile(a, probs)), abs=1e-12)
        assert got["b"] == pytest.approx(list(np.quantile(b, probs)), abs=1e-12)
    near = approximate_quantiles(df, ["a"], [0.5])["a"][0]
    assert near == pytest.approx(np.median(a), abs=0.05)


def test_quantiles_skip_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [1.5], "b": [None]}


def test_scalers_with_zero_spread(spark):
    df = spark.createDataFrame([(x, 5.0) for x in (1.0, 1.0, 1.0, 1.0, 9.0)], "x double, c double")
    robust = stages.RobustScale(["x"]).fit(df).transform(df)
    assert [r["x"] for r in robust.collect()] == [0.0, 0.0, 0.0, 0.0, 8.0]
    standard = stages.StandardScale(["x", "c"]).fit(df).transform(df).collect()
    assert [r["c"] for r in standard] == [0.0] * 5
    x = np.array([1, 1, 1, 1, 9.0])
    assert [r["x"] for r in standard] == pytest.approx(list((x - x.mean()) / x.std()))


def test_log_impute_and_missing_with_nan(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, -1.0), (4, 0.0), (5, 2.0)], "row_id int, x double")
    logged = {r["row_id"]: r["x"] for r in stages.ClippedLog(["x"]).transform(df).collect()}
    assert logged[1] is None and logged[2] is None
    assert logged[3] == logged[4] == pytest.approx(math.log(1 + 1e-5))
    assert logged[5] == pytest.approx(math.log(3))
    filled = stages.MeanImpute(["x"]).fit(df).transform(df)
    assert sorted(r["x"] for r in filled.collect()) == pytest.approx([-1, 0, 1 / 3, 1 / 3, 2])
    profile = {r["column_name"]: r for r in validate.missing_profile(df).collect()}
    assert profile["x"]["n_missing"] == 2 and profile["x"]["pct_missing"] == 40.0
    assert cols.drop_incomplete_rows(df).count() == 3


def test_one_hot_keeps_training_values(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    test = spark.createDataFrame([("b",), ("z",), (None,)], "g string")
    rows = stages.OneHot(["g"]).fit(train).transform(test).collect()
    assert [(r["g_a"], r["g_b"]) for r in rows] == [(0, 1), (0, 0), (0, 0)]


def test_column_operators(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 3.0)], "id int, a double, b double")
    with pytest.raises(ValueError):
        cols.drop_columns(df, ["a", "zzz"])
    assert cols.drop_existing_columns(df, ["a", "zzz"]).columns == ["id", "b"]
    assert cols.drop_sparse_columns(df, 0.4).columns == ["id", "b"]
    twice = df.select("id", "a", F.col("b").alias("a"))
    assert cols.drop_duplicate_columns(twice).columns == ["id", "a"]
    assert cols.normalize_names(df.withColumnRenamed("b", "Unnamed: 0")).columns == ["id", "a"]
    assert cols.numeric_columns(df, ["id"]) == ["a", "b"]
    assert cols.missing_features(df, ["a", "q"]) == ["q"]
    assert cols.same_columns(df, df.select("b", "a", "id")) and not cols.same_columns(df, df.drop("a"))
    features, label = cols.separate_label(df, "b")
    assert features.columns == ["id", "a"] and label.columns == ["b"]
    with pytest.raises(ValueError):
        cols.require_scalar(df.withColumn("v", F.array("a")), ["v"])


def test_validation_rules(spark):
    rows = [("a", -1, 0), ("a", 2, 1), ("a", 2, 0), ("b", 0, 3), ("b", 1, None)]
    df = spark.createDataFrame(rows, "entity string, hour int, label int")
    got = {r["rule"]: r["violations"] for r in validate.validate_panel(df, ROLES).collect()}
    assert got == {"negative_time": 1, "label_not_binary": 2, "duplicate_time_points": 1}
    with pytest.raises(ValueError, match="negative_time"):
        validate.assert_valid(df, ROLES)
    with pytest.raises(ValueError, match="numeric"):
        validate.validate_panel(df.withColumn("hour", F.col("hour").cast("string")), ROLES)
    with pytest.raises(ValueError, match="missing required"):
        validate.validate_panel(df.drop("hour"), ROLES)
    good = df.filter("hour in (0, 1) and label is null or hour = 2").limit(0)
    assert validate.assert_valid(good, ROLES) is good


def test_value_counts_only_for_few_values(spark):
    df = spark.range(40).selectExpr("id % 3 AS few", "id AS many")
    assert validate.value_counts(df, "few").count() == 3
    assert validate.value_counts(df, "many").count() == 0


def entities(spark, n_neg, n_pos):
    rows = [(f"n{i}", 0, 0) for i in range(n_neg)] + [(f"p{i}", 0, 1) for i in range(n_pos)]
    return spark.createDataFrame(rows, "entity string, hour int, label int")


def sizes(assignment):
    return {(r["label"], r["split"]): r["count"] for r in assignment.groupBy("label", "split").count().collect()}


def test_split_floors(spark):
    got = sizes(split.split_entities(entities(spark, 14, 6), ROLES))
    assert got == {(0, "train"): 9, (0, "val"): 2, (0, "test"): 3, (1, "train"): 4, (1, "test"): 2}
    got = sizes(split.split_entities(entities(spark, 90, 0), ROLES))
    assert got[(0, "train")] == int(90 * 0.7) == 62
    with pytest.raises(ValueError):
        split.split_entities(entities(spark, 3, 3), ROLES, train=0.8, val=0.2)


def test_split_is_the_same_under_any_partitioning(many_partitions):
    spark = many_partitions
    df = entities(spark, 60, 25)
    want = None
    for n in (1, 3, 17):
        got = {r["entity"]: r["split"] for r in split.split_entities(df.repartition(n), ROLES).collect()}
        want = want or got
        assert got == want
    assert sorted(set(want.values())) == ["test", "train", "val"]
    tagged = split.split_rows(df, split.split_entities(df, ROLES), ROLES)
    assert split.split_overlap(tagged, ROLES).count() == 0
    assert split.assert_disjoint(tagged, ROLES) is tagged
    mixed = tagged.unionByName(tagged.withColumn("split", F.lit("other")))
    with pytest.raises(ValueError):
        split.assert_disjoint(mixed, ROLES)


def brute_folds(labels, k):
    """Deal the classes, laid end to end in order of appearance, to the folds in turn."""
    order = list(dict.fromkeys(labels))
    laid = [c for c in order for y in labels if y == c]
    fold = [None] * len(labels)
    for c in order:
        share = [sum(1 for p, y in enumerate(laid) if y == c and p % k == i) for i in range(k)]
        blocks = [i for i in range(k) for _ in range(share[i])]
        mine = [i for i, y in enumerate(labels) if y == c]
        for row, f in zip(mine, blocks):
            fold[row] = f
    return fold


def test_folds_are_contiguous_blocks_per_class(many_partitions):
    spark = many_partitions
    rng = np.random.default_rng(5)
    for k, n in ((3, 50), (5, 37)):
        labels = [int(x) for x in rng.random(n) < 0.3]
        df = spark.createDataFrame(list(enumerate(labels)), "row_id long, label int").repartition(4)
        rows = split.stratified_folds(df, ROLES, k).orderBy("row_id").collect()
        assert [r["fold"] for r in rows] == brute_folds(labels, k)


def test_preparation_saves_and_loads(spark, tmp_path):
    rows = [(i, f"e{i % 4}", i, i % 2, float(i) if i % 3 else None, "m" if i % 2 else "f") for i in range(30)]
    df = spark.createDataFrame(rows, "row_id long, entity string, hour int, label int, x double, g string")
    plan = Preparation(impute=("x",), one_hot=("g",), log=("x",), scale=("x",), method="mean")
    model, done = preprocess(df, plan, ROLES)
    assert done.count() == 30 and {"g_m", "g_f"} <= set(done.columns)
    model.write().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep")).transform(df)
    assert sorted(r["x"] for r in again.collect()) == sorted(r["x"] for r in done.collect())


def test_clinical_panel_runs_with_chained_imputation(spark):
    from panelwise.plans import preprocess as plans

    rng = np.random.default_rng(0)
    numeric = [c for c in (*plans.CLINICAL_DROP_FIRST, *plans.CLINICAL_SCALE, *plans.CLINICAL_DROP_AFTER_IMPUTE)]
    rows = []
    for i in range(80):
        base = rng.normal(size=len(numeric)) * 3 + 20
        values = [None if rng.random() < 0.15 else float(v) for v in base]
        rows.append((str(i % 8), i // 8, int(i % 16 == 0), i, i % 2, i % 2, *values))
    schema = "Patient_ID string, Hour int, SepsisLabel int, row_id int, Gender int, Unit1 int, "
    df = spark.createDataFrame(rows, schema + ", ".join(f"`{c}` double" for c in numeric))
    plan = clinical_preparation(df, max_rounds=2)
    _, done = preprocess(df, plan, plans.CLINICAL_ROLES)
    assert done.count() == 80
    gone = set(plans.CLINICAL_DROP_FIRST) | set(plans.CLINICAL_DROP_AFTER_IMPUTE) | {"Gender"}
    assert not gone & set(done.columns)
    assert {"Gender_0", "Gender_1", *plans.CLINICAL_SCALE} <= set(done.columns)
