from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import counts, curves
from panelwise.roles import ColumnRoles

ROLES = ColumnRoles()

# Published confusion counts with the metrics printed next to them.
PUBLISHED = [
    ((1110, 655, 1126, 135738), (0.9872, 0.6289, 0.4964, 0.5549, 0.9952)),
    ((1152, 686, 1084, 135707), (0.9872, 0.6268, 0.5152, 0.5655, 0.9950)),
    ((1895, 7323, 341, 129070), (0.9447, 0.2056, 0.8475, 0.3309, 0.9463)),
    ((1933, 9830, 303, 126563), (0.9269, 0.1643, 0.8645, 0.2762, 0.9279)),
    ((1950, 10863, 286, 125530), (0.9196, 0.1522, 0.8721, 0.2592, 0.9204)),
]


def scored(spark, rows):
    return spark.createDataFrame(
        [(i, y, yhat, p) for i, (y, yhat, p) in enumerate(rows)], "row_id long, label int, yhat int, p double"
    )


def test_published_counts_give_published_metrics(spark):
    cells = spark.createDataFrame([c for c, _ in PUBLISHED], "tp long, fp long, fn long, tn long")
    got = cells.select(*[c.alias(n) for n, c in counts.metric_columns().items()]).collect()
    for row, (_, want) in zip(got, PUBLISHED):
        names = ("accuracy", "precision", "recall", "f1", "specificity")
        assert tuple(round(row[n], 4) for n in names) == want
    first = got[0]
    assert first["accuracy"] == 0.9871527602449703
    assert first["precision"] == 0.6288951841359773
    assert first["recall"] == 0.4964221824686941
    assert first["f1"] == pytest.approx(0.5548612846788303, abs=1e-15)
    assert first["mae"] == 0.012847239755029612
    assert first["rmse"] == 0.11334566491502712
    assert first["specificity"] == 0.9951977007617693


def test_one_class_gives_null_scores(spark):
    df = scored(spark, [(0, 0, 0.1), (0, 0, 0.9)])
    row = counts.classification_metrics(df, ROLES).first()
    assert row["specificity"] is None and row["precision"] == 0.0 and row["f1"] == 0.0
    area = curves.areas(df, ROLES).first()
    assert area["auc_roc"] is None and area["average_precision"] is None
    group = counts.group_error_analysis(df, ROLES, {"all": F.lit(True)}).first()
    assert (group["accuracy_pct"], group["fpr_pct"], group["fnr_pct"]) == (0.0, 0.0, 0.0)
    assert group["sample_size"] == 2


def test_empty_group_is_left_out_and_groups_overlap(spark):
    df = scored(spark, [(1, 1, 0.9), (0, 1, 0.8), (0, 0, 0.2), (1, 0, 0.1)])
    groups = {"all": F.lit(True), "high": F.col("p") > 0.5, "none": F.col("p") > 2}
    rows = {r["grp"]: r for r in counts.group_error_analysis(df, ROLES, groups).collect()}
    assert set(rows) == {"all", "high"}
    assert rows["all"]["accuracy_pct"] == 50.0
    assert rows["high"]["fpr_pct"] == 100.0 and rows["high"]["fnr_pct"] == 0.0


def test_four_rows(spark):
    df = scored(spark, [(0, 0, 0.1), (0, 0, 0.4), (1, 0, 0.35), (1, 1, 0.8)])
    row = curves.areas(df, ROLES).first()
    assert row["auc_roc"] == pytest.approx(0.75)
    assert row["average_precision"] == pytest.approx(0.8333333333)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    return wins / (len(pos) * len(neg))


def brute_ap(y, p):
    total, last, out = y.sum(), 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = (hit & (y == 1)).sum() / total
        out += (recall - last) * (y[hit].mean())
        last = recall
    return out


def test_areas_by_group_over_partition_borders(many_partitions):
    spark = many_partitions
    rng = np.random.default_rng(3)
    n = 400
    y, p, g = rng.integers(0, 2, n), np.round(rng.random(n), 2), rng.integers(0, 3, n)
    df = spark.createDataFrame(
        [(int(a), float(b), int(c)) for a, b, c in zip(y, p, g)], "label int, p double, g int"
    )
    whole = curves.areas(df, ROLES).first()
    assert whole["auc_roc"] == pytest.approx(brute_auc(y, p))
    assert whole["average_precision"] == pytest.approx(brute_ap(y, p))
    for row in curves.areas(df, ROLES, ["g"]).collect():
        mine = g == row["g"]
        assert row["auc_roc"] == pytest.approx(brute_auc(y[mine], p[mine]))
        assert row["average_precision"] == pytest.approx(brute_ap(y[mine], p[mine]))


def test_roc_corners_over_partition_borders(many_partitions):
    spark = many_partitions
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (0, 0.6), (0, 0.5), (1, 0.4), (0, 0.3)]
    df = spark.createDataFrame(rows, "label int, p double")
    every = curves.roc_curve(df, ROLES, drop_collinear=False).count()
    kept = sorted((r["fpr"], r["tpr"], r["threshold"]) for r in curves.roc_curve(df, ROLES).collect())
    assert every == 8
    # 0.9 is the first point; 0.6 lies on the line from 0.7 to 0.5.
    assert [t for _, _, t in kept] == [float("inf"), 0.9, 0.8, 0.5, 0.4, 0.3]


def test_calibration_bins_are_closed_on_the_right(spark):
    df = scored(spark, [(0, 0, 0.0), (1, 0, 0.1), (0, 0, 0.2), (1, 1, 0.95), (1, 1, 1.0)])
    rows = {r["bin"]: (r["n"], r["prob_true"]) for r in counts.calibration_curve(df, ROLES).collect()}
    assert rows == {0: (2, 0.5), 1: (1, 0.0), 9: (2, 1.0)}
    bad = scored(spark, [(0, 0, 1.5)])
    with pytest.raises(Exception, match="outside"):
        counts.calibration_curve(bad, ROLES).collect()


def test_normalized_matrix_has_zero_row_for_absent_class(spark):
    df = scored(spark, [(0, 1, 0.9), (0, 0, 0.1)])
    rows = {(r["actual"], r["predicted"]): r["share"] for r in counts.confusion_matrix_normalized(df, ROLES).collect()}
    assert rows == {(0, 0): 0.5, (0, 1): 0.5, (1, 0): 0.0, (1, 1): 0.0}


def test_weights(spark):
    df = scored(spark, [(0, 0, 0.1)] * 3 + [(1, 1, 0.9)])
    rows = {r["label"]: r["weight"] for r in counts.class_weights(df, "label").collect()}
    assert rows == {0: pytest.approx(4 / 6), 1: 2.0}
    weighted, total = counts.with_class_weight(df, "label")
    assert total == pytest.approx(4.0)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(4.0)
