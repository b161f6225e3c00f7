from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.operators import ordering, relations, temporal
from panelwise.roles import ColumnRoles

ROLES = ColumnRoles()


def panel(spark, n=60):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        # Entity "hot" holds most rows.
        entity = "hot" if i % 5 else f"e{i % 3}"
        rows.append((i, entity, int(rng.integers(0, 40)), None if rng.random() < 0.1 else float(rng.normal())))
    return spark.createDataFrame(rows, "row_id long, entity string, hour int, x double")


def rolled(pdf, window):
    pdf = pdf.sort_values(["entity", "hour", "row_id"])
    smooth = pdf.groupby("entity")["x"].transform(lambda s: s.rolling(window, center=True).mean())
    return dict(zip(pdf["row_id"], smooth))


@pytest.mark.parametrize("window", [3, 4, 5])
@pytest.mark.parametrize("limit", [7, 1_000_000])
def test_centered_mean_on_both_routes(many_partitions, window, limit):
    df = panel(many_partitions)
    want = rolled(df.toPandas(), window)
    out = temporal.rolling_centered_mean(df, ROLES, ["x"], window, max_entity_rows=limit)
    got = {r["row_id"]: r["x_smooth"] for r in out.collect()}
    assert set(got) == set(want)
    for key, value in want.items():
        if pd.isna(value):
            assert got[key] is None
        else:
            assert got[key] == pytest.approx(value)


def test_onsets_and_lead(spark):
    rows = [("a", 0, 0, 0), ("a", 1, 0, 1), ("a", 2, 1, 1), ("b", 0, 0, 0), ("c", 3, 1, 0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, entity string, hour int, label int, yhat int")
    got = {r["entity"]: (r["label_onset"], r["predicted_onset"], r["lead"]) for r in temporal.onset_lead(df, ROLES).collect()}
    assert got == {"a": (2, 1, 1), "b": (None, None, None), "c": (3, None, None)}
    timeline = temporal.prediction_timeline(df, ROLES)
    assert {r["entity"] for r in timeline.collect()} == {"a", "c"}


def test_attach_keeps_rows_without_prediction(spark):
    rows = spark.createDataFrame([(1,), (2,)], "row_id long")
    found = spark.createDataFrame([(1, 1, 0.9)], "row_id long, yhat int, p double")
    got = {r["row_id"]: r["yhat"] for r in temporal.attach_predictions(rows, found, ROLES).collect()}
    assert got == {1: 1, 2: None}


def test_correlations_equal_those_of_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4)) + 1e6
    x[:, 1] += x[:, 0]
    x[rng.random(x.shape) < 0.1] = np.nan
    df = spark.createDataFrame(
        [tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double"
    ).repartition(3)
    names = list("abcd")
    want = pd.DataFrame(x, columns=names).corr().abs()
    for r in relations.correlation_pairs(df, names).collect():
        assert r["corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]], abs=1e-9)


def test_infinite_values_are_left_out(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (3.0, 5.5), (float("inf"), 1.0), (4.0, float("-inf"))]
    got = relations.correlation_pairs(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).first()["corr"]
    assert got == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5.5])[0, 1])


def test_prune_counts_dropped_features_as_earlier(spark):
    a = np.linspace(0, 1, 50)
    rng = np.random.default_rng(2)
    b = a + rng.normal(size=50) * 0.05
    c = rng.normal(size=50)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c)], "a double, b double, c double")
    kept, left = relations.correlation_prune(df, ["a", "b", "c"])
    assert kept == ["a", "c"]
    assert [(r["feature_a"], r["feature_b"]) for r in left.collect()] == [("a", "c")]
    assert relations.top_correlated_pairs(df, ["a", "b", "c"], 1).first()["feature_b"] == "b"


def test_constant_feature_has_no_correlation(spark):
    rows = [(0.1, float(i), i % 2) for i in range(7)]
    df = spark.createDataFrame(rows, "a double, b double, label int").repartition(3)
    assert relations.correlation_pairs(df, ["a", "b"]).first()["corr"] is None
    lines = relations.class_trend_lines(df, [("a", "b")], "label").collect()
    assert len(lines) == 2 and all(r["slope"] is None for r in lines)


def test_positions_and_running_sums_cross_partitions(many_partitions):
    spark = many_partitions
    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("k"), F.lit(2).alias("v")).repartition(6)
    ordered = ordering.order_globally(df, "k")
    assert ordered.select(ordering.PART).distinct().count() > 1
    sums = ordering.with_running_sums(ordered, {"total": "v"})
    assert {r["k"]: r["total"] for r in sums.collect()} == {i: 2 * (i + 1) for i in range(100)}
    nexts = ordering.with_next(ordered, {"after": "k"})
    assert {r["k"]: r["after"] for r in nexts.collect()} == {i: i + 1 if i < 99 else None for i in range(100)}
    placed = ordering.with_position(df, "k")
    assert all(r["pos"] == r["k"] for r in placed.collect())
