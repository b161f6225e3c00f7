"""Confusion counts, class counts and the metrics derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwise.functions.scalar import safe_ratio
from panelwise.roles import ColumnRoles

_CELLS = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}


def _cell_sums(roles: ColumnRoles, where: Column | None = None) -> dict[str, Column]:
    """One conditional count per confusion cell; rows without prediction do not count."""
    y, yhat = F.col(roles.label), F.col(roles.prediction)
    sums = {}
    for name, (actual, predicted) in _CELLS.items():
        hit = (y == actual) & (yhat == predicted)
        sums[name] = F.count_if(hit if where is None else hit & where)
    return sums


def confusion_counts(df: DataFrame, roles: ColumnRoles, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn in one row, or one row per group of ``by``."""
    sums = [c.alias(n) for n, c in _cell_sums(roles).items()]
    return df.groupBy(*by).agg(*sums)


def confusion_matrix(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Count per (actual, predicted) that occurs."""
    return (
        df.filter(F.col(roles.label).isNotNull() & F.col(roles.prediction).isNotNull())
        .groupBy(F.col(roles.label).alias("actual"), F.col(roles.prediction).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix_normalized(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Full class-by-class matrix, each actual row divided by its total.

    The classes are all values seen as actual or predicted; a class that never
    occurs as actual gives a row of zeros.
    """
    counted = confusion_matrix(df, roles)
    pairs = counted.select(F.explode(F.array("actual", "predicted")).alias("c"))
    found = pairs.agg(F.sort_array(F.collect_set("c")).alias("classes"))
    grid = found.select(F.explode("classes").alias("actual"), "classes").select(
        "actual", F.explode("classes").alias("predicted")
    )
    full = grid.join(counted, ["actual", "predicted"], "left").na.fill(0, ["n"])
    row = F.sum("n").over(Window.partitionBy("actual"))
    return full.select(
        "actual", "predicted", safe_ratio(F.col("n"), row, 0.0).alias("share")
    )


def metric_columns() -> dict[str, Column]:
    """Metrics as expressions over tp, fp, fn, tn.

    Precision, recall and F1 are 0 when undefined.  Specificity is NULL when
    there is no negative or when the labels and predictions together show only
    one class.
    """
    tp, fp, fn, tn = (F.col(c) for c in _CELLS)
    n = tp + fp + fn + tn
    wrong = fp + fn
    two_classes = ((tp + fn + fp) > 0) & ((tn + fp + fn) > 0)
    return {
        "accuracy": safe_ratio(tp + tn, n, None),
        "precision": safe_ratio(tp, tp + fp, 0.0),
        "recall": safe_ratio(tp, tp + fn, 0.0),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn, 0.0),
        "specificity": F.when(two_classes, safe_ratio(tn, tn + fp, None)),
        "mae": safe_ratio(wrong, n, None),
        "rmse": F.sqrt(safe_ratio(wrong, n, None)),
    }


def classification_metrics(
    df: DataFrame, roles: ColumnRoles, by: Sequence[str] = ()
) -> DataFrame:
    """Label metrics from one aggregate, optionally per group."""
    counted = confusion_counts(df, roles, by)
    return counted.select(*by, *[c.alias(n) for n, c in metric_columns().items()])


def group_error_analysis(
    df: DataFrame, roles: ColumnRoles, groups: Mapping[str, Column]
) -> DataFrame:
    """Accuracy, false positive and false negative rate in percent per named group.

    Groups are predicates and may overlap, so every group gets its own
    conditional counts in a single aggregate; no row is duplicated.  A group
    that shows only one class, over labels and predictions, reports zeros.
    Empty groups are left out.  Rows without a prediction are not counted.
    """
    scored = df.filter(F.col(roles.label).isNotNull() & F.col(roles.prediction).isNotNull())
    sums, names = [], list(groups)
    for i, name in enumerate(names):
        where = F.coalesce(groups[name], F.lit(False))
        sums += [c.alias(f"g{i}_{cell}") for cell, c in _cell_sums(roles, where).items()]
    totals = scored.agg(*sums)
    rows = [
        F.struct(F.lit(name).alias("grp"), *[F.col(f"g{i}_{c}").alias(c) for c in _CELLS])
        for i, name in enumerate(names)
    ]
    long = totals.select(F.inline(F.array(*rows)))
    tp, fp, fn, tn = (F.col(c) for c in _CELLS)
    n = tp + fp + fn + tn
    two_classes = ((tp + fn + fp) > 0) & ((tn + fp + fn) > 0)

    def percent(num: Column, den: Column) -> Column:
        return F.when(two_classes, safe_ratio(num, den, 0.0) * 100.0).otherwise(F.lit(0.0))

    return long.filter(n > 0).select(
        "grp",
        percent(tp + tn, n).alias("accuracy_pct"),
        percent(fp, fp + tn).alias("fpr_pct"),
        percent(fn, fn + tp).alias("fnr_pct"),
        n.alias("sample_size"),
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label value."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counted.select("label", "n", (F.col("n") / total).alias("share"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: n / (number of classes * rows of the class)."""
    counted = (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everything = Window.partitionBy()
    total, classes = F.sum("n").over(everything), F.count("n").over(everything)
    return counted.select("label", "n", (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> tuple[DataFrame, float]:
    """Rows with the balanced weight of their class, and the sum of all weights.

    One row per class comes to the driver and becomes an expression, so the rows
    are not joined.
    """
    classes = class_weights(df, label).collect()
    weight = F.lit(None).cast("double")
    for c in classes:
        weight = F.when(F.col(label) == c["label"], F.lit(c["weight"])).otherwise(weight)
    return df.withColumn(name, weight), float(sum(c["n"] * c["weight"] for c in classes))


def calibration_curve(
    df: DataFrame, roles: ColumnRoles, n_bins: int = 10, checked: bool = True
) -> DataFrame:
    """Mean label and mean score per non-empty bin of equal width over [0, 1].

    The bin is the number of interior edges strictly below the score, so bins
    are closed on the right.  A score outside [0, 1] is an error.
    """
    p = F.col(roles.score)
    edges = [i * (1.0 / n_bins) for i in range(1, n_bins)]
    score = F.when(p.between(0.0, 1.0), p)
    if checked:
        score = score.otherwise(F.raise_error(F.lit("score outside [0, 1]")))
    bin_no = sum(((F.col("_p") > F.lit(e)).cast("int") for e in edges), F.lit(0))
    return (
        df.filter(p.isNotNull() & F.col(roles.label).isNotNull())
        .select(score.alias("_p"), F.col(roles.label).alias("_y"))
        .groupBy(bin_no.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_y").alias("prob_true"),
            F.avg("_p").alias("prob_pred"),
        )
    )


def cv_summary(per_fold: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of every metric over folds and the population deviation of F1."""
    aggs = [F.avg(m).alias(f"mean_{m}") for m in metrics]
    return per_fold.groupBy(*by).agg(*aggs, F.stddev_pop("f1").alias("f1_std"))
