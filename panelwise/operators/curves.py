"""ROC and precision-recall curves and the areas under them.

Rows are first counted per distinct score, which combines on the map side and
flattens hot scores.  Everything after that works on one row per distinct score
in the global order of :mod:`panelwise.operators.ordering`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.ordering import order_globally, with_next, with_running_sums
from panelwise.roles import ColumnRoles
from panelwise.session import broadcast_if_small


def score_counts(df: DataFrame, roles: ColumnRoles, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    y = F.col(roles.label)
    return (
        df.filter(F.col(roles.score).isNotNull() & y.isin(0, 1))
        .groupBy(*by, F.col(roles.score).cast("double").alias("threshold"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def cumulative_counts(
    df: DataFrame, roles: ColumnRoles, by: Sequence[str] = (), corners: bool = False
) -> DataFrame:
    """tp and fp when all scores >= threshold are called positive.

    ``corners`` adds ``next_pos`` and ``next_neg``, the counts at the next lower
    score, which tell the corners of the ROC curve.
    With ``by``, tp and fp run over the whole order (by, score desc); the areas
    below take the start of each group off.
    """
    ordered = order_globally(
        score_counts(df, roles, by), *[F.col(b) for b in by], F.col("threshold").desc()
    )
    if corners:
        ordered = with_next(ordered, {"next_pos": "pos", "next_neg": "neg"})
    return with_running_sums(ordered, {"tp": "pos", "fp": "neg"})


def _totals(curve: DataFrame) -> tuple[int, int]:
    """Positives and negatives; two numbers from the written score table."""
    row = curve.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    return row["p"] or 0, row["n"] or 0


def _rate(count: Column, total: int, empty: float | None = None) -> Column:
    return count / F.lit(float(total)) if total else F.lit(empty).cast("double")


def roc_curve(df: DataFrame, roles: ColumnRoles, drop_collinear: bool = True) -> DataFrame:
    """threshold, fpr, tpr by falling threshold, from (0, 0) at infinity.

    ``drop_collinear`` leaves out points on a straight line between neighbours:
    those whose own counts equal the counts of the next point.
    """
    return roc_from_cumulative(cumulative_counts(df, roles, corners=drop_collinear), drop_collinear)


def roc_from_cumulative(curve: DataFrame, drop_collinear: bool = True) -> DataFrame:
    p_total, n_total = _totals(curve)
    points = curve
    if drop_collinear:
        corner = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        points = points.filter(first | F.col("next_pos").isNull() | corner)
    points = points.select(
        "threshold",
        _rate(F.col("fp"), n_total).alias("fpr"),
        _rate(F.col("tp"), p_total).alias("tpr"),
    )
    start = curve.sparkSession.range(1 if p_total + n_total else 0).select(
        F.lit(float("inf")).alias("threshold"),
        _rate(F.lit(0.0), n_total).alias("fpr"),
        _rate(F.lit(0.0), p_total).alias("tpr"),
    )
    return start.unionByName(points)


def pr_curve(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """threshold, precision, recall; the closing point (1, 0) has no threshold."""
    return pr_from_cumulative(cumulative_counts(df, roles))


def pr_from_cumulative(curve: DataFrame) -> DataFrame:
    p_total, _ = _totals(curve)
    points = curve.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _rate(F.col("tp"), p_total, 1.0).alias("recall"),
    )
    end = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def areas(df: DataFrame, roles: ColumnRoles, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (ties count half) and average precision, one row or one per group.

    Both are NULL when only one class occurs.
    """
    return areas_from_cumulative(cumulative_counts(df, roles, by), by)


def areas_from_cumulative(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The areas from one aggregate over the curve.

    A positive beats the negatives that score lower and half of those that tie:
    P * N less the sum of pos * (fp - neg / 2).  Products of counts are doubles,
    since they outgrow bigint.
    """
    keys, tp, fp = list(by), F.col("tp"), F.col("fp")
    if keys:
        # A group starts where the running sums, less the row's own counts, are lowest.
        starts = curve.groupBy(*keys).agg(
            F.min(F.col("tp") - F.col("pos")).alias("tp0"),
            F.min(F.col("fp") - F.col("neg")).alias("fp0"),
        )
        curve = curve.join(broadcast_if_small(starts), keys)
        tp, fp = tp - F.col("tp0"), fp - F.col("fp0")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    total = curve.groupBy(*keys).agg(
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
        F.sum(pos * (fp.cast("double") - neg / 2.0)).alias("lost"),
        F.sum(pos * (tp / (tp + fp))).alias("steps"),
    )
    p, n = F.col("p"), F.col("n")
    both = (p > 0) & (n > 0)
    return total.select(
        *keys,
        F.when(both, 1.0 - F.col("lost") / (p * n)).alias("auc_roc"),
        F.when(both, F.col("steps") / p).alias("average_precision"),
    )


def roc_auc(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    return areas(df, roles).select("auc_roc")


def average_precision(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    return areas(df, roles).select("average_precision")
