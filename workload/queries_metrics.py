"""Confusion counts, metrics, curves, calibration, groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators import counts, curves
from workload.registry import query, r6
from workload.views import PANEL_SQL, ROLES, scored


@query(
    "confusion_matrix",
    f"""WITH {PANEL_SQL}
SELECT label AS actual, yhat AS predicted, count(*) AS n FROM scored GROUP BY 1, 2""",
)
def _confusion(spark, sf_dir) -> DataFrame:
    return counts.confusion_matrix(scored(spark, sf_dir), ROLES)


@query(
    "confusion_matrix_normalized",
    f"""WITH {PANEL_SQL},
c AS (SELECT label AS actual, yhat AS predicted, count(*) AS n FROM scored GROUP BY 1, 2),
k AS (SELECT DISTINCT label AS v FROM scored UNION SELECT DISTINCT yhat FROM scored),
g AS (SELECT a.v AS actual, b.v AS predicted, coalesce(c.n, 0) AS n
      FROM k a CROSS JOIN k b LEFT JOIN c ON c.actual = a.v AND c.predicted = b.v)
SELECT actual, predicted,
       round(coalesce(n / nullif(CAST(sum(n) OVER (PARTITION BY actual) AS DOUBLE), 0), 0), 6) AS share
FROM g""",
)
def _confusion_norm(spark, sf_dir) -> DataFrame:
    return r6(counts.confusion_matrix_normalized(scored(spark, sf_dir), ROLES), "share")


_CELLS_SQL = f"""WITH {PANEL_SQL},
c AS (SELECT CAST(count(*) FILTER (label = 1 AND yhat = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (label = 0 AND yhat = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (label = 1 AND yhat = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (label = 0 AND yhat = 0) AS DOUBLE) AS tn FROM scored)"""


@query(
    "classification_metrics",
    _CELLS_SQL
    + """
SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(CASE WHEN tp + fn + fp > 0 THEN tn / nullif(tn + fp, 0) END, 6) AS specificity,
       round((fp + fn) / (tp + fp + fn + tn), 6) AS mae,
       round(sqrt((fp + fn) / (tp + fp + fn + tn)), 6) AS rmse
FROM c""",
)
def _metrics(spark, sf_dir) -> DataFrame:
    return r6(counts.classification_metrics(scored(spark, sf_dir), ROLES))


@query(
    "threshold_predictions",
    f"""WITH {PANEL_SQL}
SELECT row_id, p, CASE WHEN p > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction FROM scored""",
)
def _threshold(spark, sf_dir) -> DataFrame:
    from panelwise.functions.scalar import above

    return scored(spark, sf_dir).select("row_id", "p", above(F.col("p"), 0.5).alias("prediction"))


def panel_groups():
    return {
        "reading_low": F.col("reading") < 50,
        "reading_high": F.col("reading") >= 50,
        "code_low": F.col("code") < 50,
        "code_fixed": F.col("code") == 7,
    }


@query(
    "group_error_analysis",
    f"""WITH {PANEL_SQL},
m AS (SELECT 'reading_low' AS grp, label, yhat FROM scored WHERE reading < 50
      UNION ALL SELECT 'reading_high', label, yhat FROM scored WHERE reading >= 50
      UNION ALL SELECT 'code_low', label, yhat FROM scored WHERE code < 50
      UNION ALL SELECT 'code_fixed', label, yhat FROM scored WHERE code = 7),
c AS (SELECT grp, CAST(count(*) FILTER (label = 1 AND yhat = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (label = 0 AND yhat = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (label = 1 AND yhat = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (label = 0 AND yhat = 0) AS DOUBLE) AS tn FROM m GROUP BY 1),
b AS (SELECT *, (tp + fn + fp > 0) AND (tn + fp + fn > 0) AS two FROM c)
SELECT grp,
  round(CASE WHEN two THEN (tp + tn) / (tp + tn + fp + fn) * 100 ELSE 0 END, 6) AS accuracy_pct,
  round(CASE WHEN two THEN coalesce(fp / nullif(fp + tn, 0), 0) * 100 ELSE 0 END, 6) AS fpr_pct,
  round(CASE WHEN two THEN coalesce(fn / nullif(fn + tp, 0), 0) * 100 ELSE 0 END, 6) AS fnr_pct,
  CAST(tp + tn + fp + fn AS BIGINT) AS sample_size
FROM b""",
)
def _groups(spark, sf_dir) -> DataFrame:
    return r6(counts.group_error_analysis(scored(spark, sf_dir), ROLES, panel_groups()))


@query(
    "class_distribution",
    f"""WITH {PANEL_SQL}
SELECT label, count(*) AS n,
       round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
FROM panel GROUP BY label""",
)
def _classes(spark, sf_dir) -> DataFrame:
    return r6(counts.class_distribution(scored(spark, sf_dir), "label"))


@query(
    "class_weights",
    """SELECT quality AS label, count(*) AS n,
       round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight
FROM labels GROUP BY quality""",
)
def _weights(spark, sf_dir) -> DataFrame:
    from workload.views import table

    return r6(counts.class_weights(table(spark, sf_dir, "labels"), "quality"))


_EDGES = " + ".join(f"CAST(p > CAST({i * (1.0 / 10)!r} AS DOUBLE) AS INTEGER)" for i in range(1, 10))


@query(
    "calibration_curve",
    f"""WITH {PANEL_SQL},
b AS (SELECT {_EDGES} AS bin, label, p FROM scored)
SELECT bin, count(*) AS n, round(avg(label), 6) AS prob_true, round(avg(p), 6) AS prob_pred
FROM b GROUP BY bin""",
)
def _calibration(spark, sf_dir) -> DataFrame:
    return r6(counts.calibration_curve(scored(spark, sf_dir), ROLES))


CUMULATIVE_SQL = """s AS (SELECT p AS threshold, count(*) FILTER (label = 1) AS pos,
             count(*) FILTER (label = 0) AS neg FROM scored GROUP BY p),
cum AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
             CAST(sum(pos) OVER () AS DOUBLE) AS pt, CAST(sum(neg) OVER () AS DOUBLE) AS nt,
             lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg,
             row_number() OVER w AS rn
        FROM s WINDOW w AS (ORDER BY threshold DESC))"""
_CURVE = f"WITH {PANEL_SQL}, {CUMULATIVE_SQL}"


@query(
    "roc_curve",
    f"""{_CURVE}
SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT threshold, round(fp / nt, 6), round(tp / pt, 6) FROM cum
WHERE rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg""",
)
def _roc(spark, sf_dir) -> DataFrame:
    return r6(curves.roc_curve(scored(spark, sf_dir), ROLES), "fpr", "tpr")


@query(
    "pr_curve",
    f"""{_CURVE}
SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / pt, 6) AS recall FROM cum
UNION ALL SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)""",
)
def _pr(spark, sf_dir) -> DataFrame:
    return r6(curves.pr_curve(scored(spark, sf_dir), ROLES), "precision", "recall")


@query(
    "roc_auc",
    f"{_CURVE} SELECT round(sum(pos * ((nt - fp) + neg / 2.0)) / max(pt * nt), 6) AS auc_roc FROM cum",
)
def _auc(spark, sf_dir) -> DataFrame:
    return r6(curves.roc_auc(scored(spark, sf_dir), ROLES))


@query(
    "average_precision",
    f"{_CURVE} SELECT round(sum(pos * (tp / (tp + fp))) / max(pt), 6) AS average_precision FROM cum",
)
def _ap(spark, sf_dir) -> DataFrame:
    return r6(curves.average_precision(scored(spark, sf_dir), ROLES))
