from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from panelwise.plans import histogram_trees, merged_rows, training
from panelwise.roles import ColumnRoles

ROLES = ColumnRoles().with_features("a", "b", "c")
BOOST = {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.2}
FOREST = {"n_estimators": 30, "max_depth": 4, "max_features": "sqrt"}


def frame(spark, n=4000, seed=1, wide=False):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, n) * 0.5, rng.integers(0, 6, n), np.full(n, 7.0)], axis=1)
    if wide:
        x[:, 0] = rng.normal(size=n)
    y = (x[:, 0] + (x[:, 1] - 3) ** 2 * 0.4 + rng.normal(size=n) * 0.7 > 3).astype(int)
    rows = [(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, label int, a double, b double, c double").repartition(3).cache()


@pytest.fixture
def always(monkeypatch):
    monkeypatch.setattr(merged_rows, "LEAST_ROWS", 1)


def chances(model, df):
    return np.array([r["p"] for r in training.score_batch(model, df, ROLES).orderBy("row_id").collect()])


def test_no_row_is_lost_and_edges_are_half_way(spark, always):
    df = frame(spark)
    merged = merged_rows.merge_rows(df, ["a", "b", "c"], ["label"])
    assert merged.count < 120 and merged.rows == 4000
    assert merged.cells.agg({merged_rows.ROWS: "sum"}).first()[0] == 4000
    assert [e.tolist() for e in merged.edges] == [[x / 2 + 0.25 for x in range(8)], [x + 0.5 for x in range(5)], []]
    got = merged.bucketizer().transform(df).groupBy("_bin_a", "_bin_b", "label").count().collect()
    want = merged.cells.collect()
    assert {(r["_bin_a"], r["_bin_b"], r["label"], r["count"]) for r in got} == {(r["_bin_a"], r["_bin_b"], r["label"], r["_rows"]) for r in want}
    wide = merged_rows.merge_rows(frame(spark, wide=True), ["a", "b"], ["label"])
    sizes = [r["sum(_rows)"] for r in wide.cells.groupBy("_bin_a").sum("_rows").collect()]
    assert len(sizes) == 32 and max(sizes) - min(sizes) <= 2


def test_rows_are_merged_only_where_that_helps(spark, monkeypatch):
    df = frame(spark)
    assert merged_rows.merge_rows(df, ["a", "b"], ["label"]) is None
    monkeypatch.setattr(merged_rows, "LEAST_ROWS", 1)
    assert merged_rows.merge_rows(df, ["a", "b"], ["label"]) is not None
    assert merged_rows.merge_rows(df, ["a", "b"], ["row_id"]) is None
    for gap in ("nullif(b, 2)", "if(b = 2, double('NaN'), b)"):
        assert merged_rows.merge_rows(df.selectExpr("a", f"{gap} AS b", "label"), ["a", "b"], ["label"]) is None
    assert merged_rows.merge_rows(df.selectExpr("a", "b", "nullif(label, 1) AS label"), ["a", "b"], ["label"]) is None
    three = training.fit_model("random_forest", FOREST, df.selectExpr("row_id", "label + int(b = 5) AS label", "a", "b", "c"), ROLES)
    assert three.stages[-1].numClasses == 3


def test_boosting_on_merged_rows_gives_the_trees_of_all_rows(spark, monkeypatch):
    df = frame(spark)
    plain = training.fit_model("gradient_boosting", BOOST, df, ROLES)
    monkeypatch.setattr(merged_rows, "LEAST_ROWS", 1)
    merged = training.fit_model("gradient_boosting", BOOST, df, ROLES)
    assert "Bucketizer" in type(merged.stages[0]).__name__
    assert np.allclose(chances(plain, df), chances(merged, df), atol=1e-9)
    between = df.selectExpr("row_id", "label", "a + 0.1 AS a", "b - 0.2 AS b", "c")
    assert np.allclose(chances(plain, between), chances(merged, between), atol=1e-9)
    assert np.allclose(plain.stages[-1].featureImportances.toArray(), merged.stages[-1].featureImportances.toArray())
    sampled = training.fit_model("gradient_boosting", BOOST | {"subsample": 0.5}, df, ROLES)
    assert "Bucketizer" not in type(sampled.stages[0]).__name__


def test_forest_on_merged_rows(spark, monkeypatch, tmp_path):
    df = frame(spark)
    plain = training.fit_model("random_forest", FOREST, df, ROLES)
    monkeypatch.setattr(merged_rows, "LEAST_ROWS", 1)
    merged = training.fit_model("random_forest", FOREST, df, ROLES)
    assert isinstance(merged.stages[-1], histogram_trees.TreesModel)
    p = chances(merged, df)
    assert np.corrcoef(chances(plain, df), p)[0, 1] > 0.98
    assert np.abs(plain.stages[-1].featureImportances.toArray() - merged.stages[-1].featureImportances.toArray()).max() < 0.1
    assert np.allclose(p, chances(training.fit_model("random_forest", FOREST, df.repartition(5), ROLES), df), atol=1e-9)
    merged.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert np.array_equal(p, chances(again, df))
    assert again.stages[-1].featureImportances == merged.stages[-1].featureImportances


@pytest.mark.parametrize("rows", [1, 3, 64, 65, 5000])
def test_draws_of_merged_rows_are_those_of_their_rows(rows):
    keys = np.arange(200_000).astype(np.uint64)
    drawn = histogram_trees._drawn(keys, 7, np.full(len(keys), float(rows)))
    assert abs(drawn.mean() / rows - 1) < 6 / np.sqrt(rows * len(keys)) and abs(drawn.var() / rows - 1) < 0.03
    if rows == 1:
        assert np.array_equal(drawn, histogram_trees._poisson(histogram_trees._uniform(keys, 7)))
