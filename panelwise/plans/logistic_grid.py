"""Logistic regressions of all folds and settings at once, one pass over the rows per round.

A round is a step of Newton's method.  Tasks add up, for every model, the slope and the
curvature of its loss over the rows it is trained on; the sums reach the driver, which is one
matrix of the features' size per model.  The penalties' part of a step, absolute values
too, is solved there by coordinate descent.  The number of passes is that of the slowest
model's rounds, not of folds times settings.

The models are those of ``training.cross_validate``: features scaled by mean and deviation
of the fold's training rows, rows weighted by class, mean loss with the penalty of ``C``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.functions.scalar import above
from panelwise.operators.counts import cv_summary
from panelwise.operators.split import stratified_folds
from panelwise.plans.training import (
    CV_METRICS,
    DECISION,
    FOLDS,
    MAX_FOLDS,
    SEED,
    TRIAL_SCHEMA,
    check_params,
    draw_params,
    evaluate,
)
from panelwise.roles import ColumnRoles
from panelwise.session import materialize

#: Numbers that a round may bring to the driver; more models are fitted in several groups.
MOST_SUMS = 4_000_000
ROUNDS, CLOSE = 100, 1e-8


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], axis=1)


def _fold_stats(rows: DataFrame, names: Sequence[str], label: str) -> dict[int, tuple]:
    """Of the rows outside each fold: mean and deviation of the features, and the weight of each label."""
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(names)] + [F.sum(F.col(c) * F.col(c)).alias(f"q{i}") for i, c in enumerate(names)]
    # Sums about the overall means, so that large means cost no digits.
    middle = rows.agg(*[F.avg(c).alias(c) for c in names]).first()
    moved = rows.select("fold", F.col(label).alias("_y"), *[(F.col(c) - F.lit(middle[c] or 0.0)).alias(c) for c in names])
    cells = moved.groupBy("fold", "_y").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    out = {}
    for fold in sorted({r["fold"] for r in cells}):
        kept = [r for r in cells if r["fold"] != fold]
        n = {}
        for r in kept:
            n[r["_y"]] = n.get(r["_y"], 0) + r["n"]
        total = sum(n.values())
        if not total:
            continue
        mean = np.array([sum(r[f"s{i}"] for r in kept) for i in range(len(names))]) / total
        square = np.array([sum(r[f"q{i}"] for r in kept) for i in range(len(names))]) / total
        spread = np.sqrt(np.maximum(square - mean**2, 0.0))
        spread[spread <= 1e-12 * np.sqrt(np.maximum(square, 1e-300))] = 1.0
        weights = {y: total / (len(n) * count) for y, count in n.items()}
        base = np.array([middle[c] or 0.0 for c in names])
        out[fold] = (mean + base, spread, weights, float(total))
    return out


def _penalties(params: Mapping[str, Any]) -> tuple[float, float]:
    """Weight of the penalty relative to the summed loss, and the absolute values' share of it."""
    mix = {"l1": 1.0, "l2": 0.0, "elasticnet": float(params.get("l1_ratio", 0.5))}[params.get("penalty", "l2")]
    return 1.0 / float(params.get("C", 1.0)), mix


def _step(weights: np.ndarray, slope: np.ndarray, curve: np.ndarray, strength: float, mix: float) -> np.ndarray:
    """Least of the quadratic model of the loss with the penalties, by coordinate descent; the constant comes last."""
    ridge = np.append(np.full(len(weights) - 1, strength * (1 - mix)), 0.0)
    lasso = np.append(np.full(len(weights) - 1, strength * mix), 0.0)
    curve = curve + 1e-10 * np.eye(len(weights)) * max(np.trace(curve) / len(weights), 1e-12)
    if not mix:
        return weights - np.linalg.solve(curve + np.diag(ridge), slope + ridge * weights)
    new = weights.copy()
    pull = slope.copy()  # slope of the quadratic model at ``new``
    for _ in range(1_000):
        largest = 0.0
        for j in range(len(new)):
            bend = curve[j, j] + ridge[j]
            free = curve[j, j] * new[j] - pull[j]
            value = np.sign(free) * max(abs(free) - lasso[j], 0.0) / bend if bend > 0 else 0.0
            if value != new[j]:
                pull += curve[:, j] * (value - new[j])
                largest = max(largest, abs(value - new[j]))
                new[j] = value
        if largest < 1e-12:
            break
    return new


def fit_grid(rows: DataFrame, settings: Sequence[Mapping[str, Any]], names: Sequence[str], label: str, passes: list | None = None) -> dict:
    """(fold, setting) -> (mean, deviation, weights with the constant last) for rows with a column ``fold``.

    A model's fold is the one it is not trained on.  ``passes`` receives an entry per pass over the rows.
    """
    for params in settings:
        check_params(params, "logistic_regression")
    stats, d = _fold_stats(rows, names, label), len(names)
    models = [(fold, s) for fold in stats for s in range(len(settings))]
    at_once = max(1, MOST_SUMS // ((d + 1) * (d + 2)))
    out = {}
    for start in range(0, len(models), at_once):
        some = models[start : start + at_once]
        weights = {m: np.zeros(d + 1) for m in some}
        losses: dict = {}
        steps: dict = {}
        open_ = list(some)
        for round_ in range(ROUNDS):
            if not open_:
                break
            if passes is not None:
                passes.append(len(open_))
            found = _sums(rows, names, label, stats, {m: weights[m] for m in open_})
            still = []
            for m in open_:
                strength, mix = _penalties(settings[m[1]])
                loss, slope, curve = found[m]
                w = weights[m]
                full = loss + strength * (mix * np.abs(w[:-1]).sum() + (1 - mix) / 2 * (w[:-1] ** 2).sum())
                if m in losses and full > losses[m] + 1e-9 * abs(losses[m]):
                    # The step was too long: half of it.
                    before, step = steps[m]
                    steps[m] = before, step / 2
                    weights[m] = before + step / 2
                    if np.abs(step).max() > CLOSE:
                        still.append(m)
                    continue
                losses[m] = full
                new = _step(w, slope, curve, strength, mix)
                steps[m] = w, new - w
                weights[m] = new
                if np.abs(new - w).max() > CLOSE and round_ + 1 < int(settings[m[1]].get("max_iter", 100)):
                    still.append(m)
            open_ = still
        out |= {m: (*stats[m[0]][:2], weights[m]) for m in some}
    return out


def _sums(rows: DataFrame, names: Sequence[str], label: str, stats: dict, weights: dict) -> dict:
    """Loss, slope and curvature of every model, from one pass."""
    models, d = list(weights), len(names)
    width = 1 + (d + 1) + (d + 1) ** 2
    by_fold: dict = {}
    for number, (fold, _) in enumerate(models):
        by_fold.setdefault(fold, []).append(number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, of = _matrix(batch, names), batch.column("_y").to_numpy().astype(float), batch.column("fold").to_numpy()
            for fold, numbers in by_fold.items():
                mean, spread, by_label, _ = stats[fold]
                mine = np.flatnonzero(of != fold)
                z = np.append((x[mine] - mean) / spread, np.ones((len(mine), 1)), axis=1)
                w = np.array([by_label[v] for v in y[mine].astype(int)])
                for number in numbers:
                    margin = z @ weights[models[number]]
                    p = 1 / (1 + np.exp(-margin))
                    total[number, 0] += (w * (np.logaddexp(0, margin) - y[mine] * margin)).sum()
                    total[number, 1 : d + 2] += z.T @ (w * (p - y[mine]))
                    total[number, d + 2 :] += (z.T @ (z * (w * p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "v"])

    cells = rows.select("fold", F.col(label).cast("int").alias("_y"), *names).mapInArrow(work, "cell long, v double")
    table = cells.groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros(len(models) * width)
    total[table["cell"].to_numpy()] = table["v"].to_numpy()
    total = total.reshape(len(models), width)
    return {m: (t[0], t[1 : d + 2], t[d + 2 :].reshape(d + 1, d + 1)) for m, t in zip(models, total)}


def cross_validate_grid(
    settings: Sequence[Mapping[str, Any]], df: DataFrame, roles: ColumnRoles, k: int | None = None, fold_column: str | None = None, passes: list | None = None
) -> DataFrame:
    """(setting, fold, f1, accuracy, auc_roc, precision, recall) of every setting on every held-out fold.

    As ``training.cross_validate`` for each of the logistic regression's ``settings``, numbered
    in their order.  ``max_iter`` bounds the rounds; ``tol`` is not needed.
    """
    if fold_column is None:
        rows = materialize(stratified_folds(df, roles, k or FOLDS["logistic_regression"]), "folds")
    else:
        rows = df.withColumnRenamed(fold_column, "fold")
    present = [r["fold"] for r in rows.select("fold").distinct().limit(MAX_FOLDS + 1).collect()]
    if None in present or len(present) > MAX_FOLDS:
        raise ValueError(f"every row needs one of at most {MAX_FOLDS} folds")
    names = list(roles.features)
    fitted = fit_grid(rows, settings, names, roles.label, passes)
    count = len(settings)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, of = _matrix(batch, names), batch.column("fold").to_numpy()
            p = np.zeros((count, len(x)))
            for fold in np.unique(of):
                mine = np.flatnonzero(of == fold)
                for s in range(count):
                    mean, spread, w = fitted[fold, s]
                    p[s, mine] = 1 / (1 + np.exp(-(((x[mine] - mean) / spread) @ w[:-1] + w[-1])))
            for s in range(count):
                columns = [pa.array(np.full(len(x), s, np.int32)), pa.array(of.astype(np.int32)), batch.column("_y"), pa.array(p[s])]
                yield pa.RecordBatch.from_arrays(columns, names=["setting", "fold", "_y", "_p"])

    scored = rows.select("fold", F.col(roles.label).cast("int").alias("_y"), *names).mapInArrow(score, "setting int, fold int, _y int, _p double")
    scored = scored.select("setting", "fold", F.col("_y").alias(roles.label), F.col("_p").alias(roles.score), above(F.col("_p"), DECISION).alias(roles.prediction))
    return evaluate(materialize(scored, "held_out"), roles, ["setting", "fold"]).select("setting", "fold", *CV_METRICS)


def search_grid(
    df: DataFrame, roles: ColumnRoles, n_trials: int, k: int | None = None, seed: int = SEED, space: Mapping | None = None, passes: list | None = None
) -> DataFrame:
    """The trials table of ``training.search_trials`` for the logistic regression, all trials fitted together.

    A random search draws its trials beforehand, so one pass per round serves them all.
    Trials whose parameters are refused have state ``FAIL``.
    """
    drawn = [draw_params("logistic_regression", i, seed, space) for i in range(n_trials)]
    fits, rows = [], []
    for number, params in enumerate(drawn):
        try:
            check_params(params, "logistic_regression")
            _penalties(params)
            fits.append(number)
        except (KeyError, ValueError, ZeroDivisionError):
            rows.append((number, "FAIL", *[None] * 8, _text(params)))
    if n_trials and not fits:
        raise RuntimeError("no trial completed")
    if fits:
        per_fold = cross_validate_grid([drawn[i] for i in fits], df, roles, k, passes=passes)
        for r in cv_summary(per_fold, CV_METRICS, ["setting"]).collect():
            number = fits[r["setting"]]
            found = [r[f"mean_{m}"] for m in ("f1", "accuracy", "auc_roc", "precision", "recall")]
            rows.append((number, "COMPLETE", found[0], *found, r["f1_std"], number, _text(drawn[number])))
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda r: r[0]), TRIAL_SCHEMA)


def _text(params: Mapping[str, Any]) -> dict[str, str | None]:
    return {n: None if v is None else str(v) for n, v in params.items()}
