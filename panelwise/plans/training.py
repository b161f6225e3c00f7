"""Model families, cross-validation, search and selection on MLlib estimators."""

from __future__ import annotations

import math
import random
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.errors.exceptions.captured import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.functions.scalar import above
from panelwise.operators.counts import classification_metrics, cv_summary, with_class_weight
from panelwise.operators.curves import areas
from panelwise.operators.split import stratified_folds
from panelwise.operators.stages import StandardScale
from panelwise.plans.histogram_trees import fit_boosting, fit_forest, fit_merged_forest
from panelwise.plans.merged_rows import BINS, ROWS, Merged, bin_column, merge_rows
from panelwise.roles import ColumnRoles
from panelwise.session import materialize, path_exists, small_frame

_VECTOR, _WEIGHT = "_features", "_weight"
# Deepest tree MLlib accepts, seed, folds per family, decision threshold.
MAX_DEPTH = 30
SEED = 42
FOLDS = {"random_forest": 5, "logistic_regression": 5, "gradient_boosting": 3}
DECISION = 0.5
# Folds that a given fold column may have; each is one model.
MAX_FOLDS = 1_000
CV_METRICS = ("f1", "accuracy", "auc_roc", "precision", "recall")

# Search space per family, as (kind, low, high) or (kind, choices).
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    "random_forest": {
        "n_estimators": ("int", 190, 210),
        "max_depth": ("int", 5, MAX_DEPTH),
        "min_samples_split": ("int", 2, 8),
        "min_samples_leaf": ("int", 1, 5),
        "max_features": ("choice", ("sqrt", "log2", None)),
    },
    "logistic_regression": {
        "penalty": ("choice", ("l1", "l2", "elasticnet")),
        "C": ("log", 0.001, 100.0),
        "max_iter": ("int", 500, 1500),
        "tol": ("float", 1e-5, 1e-3),
        "l1_ratio": ("float", 0.0, 1.0),
    },
    "gradient_boosting": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 3, 10),
        "learning_rate": ("log", 0.01, 0.3),
        "subsample": ("float", 0.5, 1.0),
        "colsample_bytree": ("float", 0.5, 1.0),
        "gamma": ("float", 0.0, 5.0),
        "reg_alpha": ("float", 0.0, 1.0),
        "reg_lambda": ("float", 0.0, 1.0),
    },
}
# Parameters that only apply when another one has a certain value.
_CONDITIONAL = {"l1_ratio": ("penalty", "elasticnet")}


# Parameters without a counterpart in MLlib, by the family whose histogram trees have them.
HISTOGRAM_PARAMS = {
    "random_forest": frozenset(("min_samples_split",)),
    "gradient_boosting": frozenset(("reg_alpha", "reg_lambda", "min_child_weight")),
}


def uses_histograms(family: str, params: Mapping[str, Any]) -> bool:
    """Whether the parameters ask for trees that MLlib does not have."""
    return bool(HISTOGRAM_PARAMS.get(family, frozenset()) & params.keys())


def check_params(params: Mapping[str, Any], family: str | None = None) -> None:
    """Refuse parameters that could not take effect as given."""
    special = frozenset().union(*HISTOGRAM_PARAMS.values())
    unknown = sorted((special - HISTOGRAM_PARAMS.get(family, frozenset())) & params.keys())
    if unknown:
        raise ValueError(f"parameters without effect: {unknown}")
    depth = params.get("max_depth")
    if depth is not None and int(depth) > MAX_DEPTH and not uses_histograms(family, params):
        raise ValueError(f"max_depth {depth} is above {MAX_DEPTH}")


def _random_forest(params: Mapping[str, Any], roles: ColumnRoles, weight_sum: float):
    """No ``max_depth`` means the deepest tree there is."""
    return RandomForestClassifier(
        numTrees=int(params.get("n_estimators", 100)),
        maxDepth=int(params.get("max_depth") or MAX_DEPTH),
        minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        featureSubsetStrategy=params.get("max_features", "sqrt") or "all",
        weightCol=_WEIGHT,
        seed=SEED,
    )


def _logistic_regression(params: Mapping[str, Any], roles: ColumnRoles, weight_sum: float):
    """C multiplies the loss sum, regParam the penalty of the mean loss: 1 / (C * weights)."""
    mix = {"l1": 1.0, "l2": 0.0, "elasticnet": float(params.get("l1_ratio", 0.5))}
    return LogisticRegression(
        regParam=1.0 / (float(params.get("C", 1.0)) * weight_sum),
        elasticNetParam=mix[params.get("penalty", "l2")],
        maxIter=int(params.get("max_iter", 100)),
        tol=float(params.get("tol", 1e-4)),
        standardization=False,
        weightCol=_WEIGHT,
    )


def _gradient_boosting(params: Mapping[str, Any], roles: ColumnRoles, weight_sum: float):
    """``gamma`` is a gain summed over rows, the least gain of MLlib one per row."""
    return GBTClassifier(
        maxIter=int(params.get("n_estimators", 100)),
        maxDepth=int(params.get("max_depth", 6)),
        stepSize=float(params.get("learning_rate", 0.3)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy=str(float(params.get("colsample_bytree", 1.0))),
        minInfoGain=float(params.get("gamma", 0.0)) / weight_sum,
        seed=SEED,
    )


FAMILIES: dict[str, Callable] = {
    "random_forest": _random_forest,
    "logistic_regression": _logistic_regression,
    "gradient_boosting": _gradient_boosting,
}
# Choices of features per node that merged rows are grown by; shares and numbers are left to MLlib.
_MERGED_FEATURES = ("sqrt", "log2", "all", None)
# Families whose rows are weighted by class.
BALANCED = ("random_forest", "logistic_regression")


def fit_model(
    family: str, params: Mapping[str, Any], train: DataFrame, roles: ColumnRoles
) -> PipelineModel:
    """Scale, assemble, fit.  The features are those named in ``roles``.

    Trees with parameters that MLlib lacks are grown from histograms; they do not
    depend on the scale of a feature.  Trees on many rows are grown from rows merged
    by their bins, where those are far fewer.
    """
    check_params(params, family)
    key = roles.row_id if roles.row_id in train.columns else None
    if uses_histograms(family, params) and family == "random_forest":
        train, _ = with_class_weight(train, roles.label, _WEIGHT)
        return PipelineModel([fit_forest(params, train, roles.features, roles.label, _WEIGHT, key, SEED)])
    if uses_histograms(family, params):
        return PipelineModel([fit_boosting(params, train, roles.features, roles.label, key, SEED)])
    if family in BALANCED:
        train, weight_sum = with_class_weight(train, roles.label, _WEIGHT)
    else:
        weight_sum = float(max(train.count(), 1)) if params.get("gamma") else 1.0
    if family == "random_forest" and params.get("max_features", "sqrt") in _MERGED_FEATURES:
        merged = merge_rows(train, roles.features, [roles.label, _WEIGHT])
        if merged is not None and merged.cells.filter(~F.col(roles.label).isin(0, 1)).isEmpty():
            return PipelineModel([fit_merged_forest(params, merged, roles.label, _WEIGHT, int(params.get("max_depth") or MAX_DEPTH), SEED)])
    estimator = FAMILIES[family](params, roles, weight_sum)
    if family == "gradient_boosting" and float(params.get("subsample", 1.0)) == 1.0:
        merged = merge_rows(train, roles.features, [roles.label])
        if merged is not None:
            return _boost_merged(estimator, merged, roles)
    estimator.setFeaturesCol(_VECTOR).setLabelCol(roles.label)
    names = list(roles.features)
    steps = [StandardScale(names), VectorAssembler(inputCols=names, outputCol=_VECTOR), estimator]
    return Pipeline(stages=steps).fit(train)


def _boost_merged(estimator: GBTClassifier, merged: Merged, roles: ColumnRoles) -> PipelineModel:
    """Boosting on merged rows weighted by their number: the sums, so the trees, are those of all rows.

    MLlib looks for values in a sample of the square of ``maxBins`` rows, so that is set to see all of them.
    """
    bins = [bin_column(f) for f in merged.features]
    estimator.setFeaturesCol(_VECTOR).setLabelCol(roles.label).setWeightCol(ROWS)
    estimator.setMaxBins(max(BINS, math.ceil(math.sqrt(merged.count))))
    vectors = VectorAssembler(inputCols=bins, outputCol=_VECTOR)
    return PipelineModel([merged.bucketizer(), vectors, estimator.fit(vectors.transform(merged.cells))])


def score_batch(model: PipelineModel, df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Rows with the positive-class probability and the prediction.

    The columns of ``df`` come back unscaled: features are scaled on a copy.
    """
    kept = [c for c in df.columns if c not in (roles.score, roles.prediction)]
    raw = df.select(F.struct(*kept).alias("_row"), *roles.features)
    p = vector_to_array("probability")[1]
    scored = model.transform(raw).select("_row.*", p.alias(roles.score))
    return scored.withColumn(roles.prediction, above(F.col(roles.score), DECISION))


def evaluate(scored: DataFrame, roles: ColumnRoles, by: Sequence[str] = ()) -> DataFrame:
    """Label and score metrics in one row, or one row per group."""
    labels = classification_metrics(scored, roles, by)
    scores = areas(scored, roles, by)
    if by:
        return labels.join(scores, list(by))
    row = scores.first()
    return labels.withColumns({c: F.lit(row[c]).cast("double") for c in scores.columns})


def train_evaluate(
    family: str, params: Mapping[str, Any], train: DataFrame, held_out: DataFrame, roles: ColumnRoles
) -> tuple[PipelineModel, DataFrame]:
    """Fit on train, score the held-out rows, return model and metrics."""
    model = fit_model(family, params, train, roles)
    scored = materialize(score_batch(model, held_out, roles), "scored")
    return model, evaluate(scored, roles)


def cross_validate(
    family: str,
    params: Mapping[str, Any],
    df: DataFrame,
    roles: ColumnRoles,
    k: int | None = None,
    resample: Callable[[DataFrame], DataFrame] | None = None,
    parallelism: int = 3,
    fold_column: str | None = None,
) -> DataFrame:
    """Five metrics per fold: fold, f1, accuracy, auc_roc, precision, recall.

    With ``fold_column`` the folds are those present in that column, each is held
    out once, and a ``k`` that is not their number is an error; a row without a
    fold is one too.  Else ``k`` stratified folds are made.  ``resample`` is applied to the training part of every fold only, so that
    held-out rows never help to make training rows.
    """
    if fold_column is None:
        folds = materialize(stratified_folds(df, roles, k or FOLDS[family]), "folds")
    else:
        folds = df.withColumnRenamed(fold_column, "fold")
    present = [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").limit(MAX_FOLDS + 1).collect()]
    if None in present or len(present) > MAX_FOLDS:
        raise ValueError(f"every row needs one of at most {MAX_FOLDS} folds")
    if fold_column is not None and k is not None and k != len(present):
        raise ValueError(f"{len(present)} folds are present, not {k}")

    def run(i: int) -> DataFrame:
        train = folds.filter(F.col("fold") != i)
        if resample is not None:
            train = materialize(resample(train), "resampled")  # read by every pass of the fit
        model = fit_model(family, params, train, roles)
        scored = score_batch(model, folds.filter(F.col("fold") == i), roles)
        return scored.select("fold", roles.label, roles.score, roles.prediction)

    parts = _in_threads(run, present, parallelism)
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    scored = materialize(scored, "held_out")
    return evaluate(scored, roles, ["fold"]).select("fold", *CV_METRICS)


def _in_threads(fn: Callable, items, parallelism: int) -> list:
    """Run Spark jobs from a few driver threads."""
    items = list(items)
    if parallelism <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(fn), items))


def draw_params(family: str, number: int, seed: int = SEED, space: Mapping | None = None) -> dict[str, Any]:
    """Parameters of one trial; the same number and seed give the same draw."""
    rng = random.Random(f"{seed}:{family}:{number}")
    drawn: dict[str, Any] = {}
    for name, (kind, *bounds) in (space or SEARCH_SPACES[family]).items():
        if kind == "int":
            value = rng.randint(*bounds)
        elif kind == "float":
            value = rng.uniform(*bounds)
        elif kind == "log":
            low, high = bounds
            value = low * (high / low) ** rng.random()
        else:
            value = rng.choice(bounds[0])
        needs = _CONDITIONAL.get(name)
        if needs is None or drawn.get(needs[0]) == needs[1]:
            drawn[name] = value
    return drawn


# What wrong parameters raise, in Python or in MLlib.
_REFUSALS = (ValueError, KeyError, IllegalArgumentException)
TRIAL_SCHEMA = (
    "number int, state string, value double, f1_score double, accuracy double, roc_auc double, "
    "precision double, recall double, f1_std double, cv_iteration int, params map<string,string>"
)


def search_trials(
    family: str,
    df: DataFrame,
    roles: ColumnRoles,
    n_trials: int,
    k: int | None = None,
    seed: int = SEED,
    space: Mapping | None = None,
    resample: Callable[[DataFrame], DataFrame] | None = None,
    parallelism: int = 1,
    path: str | None = None,
) -> DataFrame:
    """Trials table of a seeded random search for the largest mean F1.

    Folds are made once for all trials.  A trial whose parameters are refused is
    kept with state ``FAIL``; the others are ``COMPLETE``, and any other error
    ends the search, as does a search in which no trial completes.  With ``path``
    each trial is appended to the table there when it is done, and numbers that
    are already there are not run again.
    """
    spark = df.sparkSession
    known = set()
    if path is not None and path_exists(spark, path):
        known = {r["number"] for r in spark.read.schema(TRIAL_SCHEMA).parquet(path).select("number").collect()}
    k = k or FOLDS[family]
    folds = materialize(stratified_folds(df, roles, k), "folds")

    def run(number: int) -> tuple:
        params = draw_params(family, number, seed, space)
        text = {n: None if v is None else str(v) for n, v in params.items()}
        try:
            per_fold = cross_validate(family, params, folds, roles, k, resample, fold_column="fold")
            s = cv_summary(per_fold, CV_METRICS).first()
        except _REFUSALS as exc:
            warnings.warn(f"trial {number} of {family} failed: {exc}", stacklevel=2)
            row = (number, "FAIL", *[None] * 8, text)
        else:
            means = [s[f"mean_{m}"] for m in ("f1", "accuracy", "auc_roc", "precision", "recall")]
            row = (number, "COMPLETE", means[0], *means, s["f1_std"], number, text)
        if path is not None:
            spark.createDataFrame([row], TRIAL_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return row

    rows = _in_threads(run, [i for i in range(n_trials) if i not in known], parallelism)
    table = spark.createDataFrame(rows, TRIAL_SCHEMA) if path is None else spark.read.schema(TRIAL_SCHEMA).parquet(path)
    if n_trials and table.filter("state = 'COMPLETE'").isEmpty():
        raise RuntimeError(f"no trial of {family} completed")
    return table


def best_trial(trials: DataFrame) -> DataFrame:
    """The completed trial with the largest value; ties go to the earlier number."""
    done = trials.filter((F.col("state") == "COMPLETE") & F.col("value").isNotNull())
    return done.orderBy(F.desc("value"), "number").limit(1)


def best_model(metrics: DataFrame, metric: str = "f1", order: str = "ord") -> DataFrame:
    """Row with the strictly largest metric; ties go to the smaller ``order``."""
    known = metrics.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
    return known.orderBy(F.desc(metric), order).limit(1)


def feature_importance(model: PipelineModel, roles: ColumnRoles, spark, n: int = 20) -> DataFrame:
    """The n largest importances: of trees, or absolute coefficients of a linear model."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = abs(last.coefficients.toArray())
    rows = [(name, float(v)) for name, v in zip(roles.features, values)]
    table = small_frame(spark, rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def compare_families(
    train: DataFrame,
    val: DataFrame,
    roles: ColumnRoles,
    params: Mapping[str, Mapping[str, Any]],
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Train and evaluate every family; the metrics table has one row per model."""
    models: dict[str, PipelineModel] = {}
    table = None
    for i, (family, chosen) in enumerate(params.items()):
        models[family], found = train_evaluate(family, chosen, train, val, roles)
        row = found.select(F.lit(family).alias("model"), F.lit(i).alias("ord"), "*")
        table = row if table is None else table.unionByName(row)
    return models, table
