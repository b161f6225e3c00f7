"""How much of a search's objective each parameter decides: variance of a fitted forest by parameter.

A forest is fitted to parameters and objective of the trials.  Each of its trees cuts the space
into boxes with one value each.  The mean over all other parameters, as one parameter
moves, is a sum over the boxes; its variance against that of the whole tree is the
parameter's share (Hutter, Hoos, Leyton-Brown, "An Efficient Approach for Assessing
Hyperparameter Importance", ICML 2014).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.plans.histogram_trees import Tree, TreesModel, fit_forest
from panelwise.session import small_frame

#: Trees of the forest, and values of a parameter that are told apart.
TREES, LEVELS = 48, 512
#: Values of a parameter that is not a number, at most.
MAX_CHOICES = 256


def _encoded(trials: DataFrame, space: Mapping[str, tuple] | None) -> tuple[DataFrame, list[str], dict[str, int]]:
    """Trials as numbers, a column ``p0``, ``p1``, ... per parameter; names; and the choices of those that are no numbers."""
    done = trials.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    long = done.select("number", "value", F.explode("params").alias("param", "text"))
    number = F.expr("try_cast(text AS double)")
    kinds = long.groupBy("param").agg(
        F.min(F.col("text").isNull() | number.isNotNull()).alias("numeric"), F.count(number).alias("known"),
        F.slice(F.sort_array(F.collect_set(F.coalesce("text", F.lit("None")))), 1, MAX_CHOICES).alias("choices"),
    )
    rows = kinds.orderBy("param").limit(10_000).collect()
    names, choices, columns = [], {}, []
    for i, r in enumerate(rows):
        kind = space[r["param"]][0] if space and r["param"] in space else None
        text = F.col("params")[r["param"]]
        if kind == "choice" or not (r["numeric"] and r["known"]):
            known = [c if c is None else str(c) for c in space[r["param"]][1]] if kind == "choice" else r["choices"]
            known = ["None" if c is None else c for c in known]
            choices[r["param"]] = len(known)
            place = F.array_position(F.array(*[F.lit(c) for c in known]), F.coalesce(text, F.lit("None"))) - 1
            columns.append(F.when(place >= 0, place).cast("double").alias(f"p{i}"))
        else:
            value = F.expr(f"try_cast(params['{r['param']}'] AS double)")
            columns.append((F.log(value) if kind == "log" else value).alias(f"p{i}"))
        names.append(r["param"])
    return done.select("number", F.col("value").cast("double").alias("value"), *columns), names, choices


def _borders(edges: np.ndarray, top: float | None, choices: int | None, bounds: tuple | None) -> np.ndarray:
    """Where the bins of a parameter end, from 0 to 1; they lie midway between its values."""
    values = np.append(edges, top) if top is not None else np.asarray(edges, float)
    if len(values) < 2 and choices is None and bounds is None:
        return np.array([1.0])
    middles = (values[1:] + values[:-1]) / 2
    if choices is not None:
        low, high = -0.5, choices - 0.5
    elif bounds is not None:
        low, high = bounds
    else:
        low, high = values[0] - (values[1] - values[0]) / 2, values[-1] + (values[-1] - values[-2]) / 2
    return np.append(np.clip((middles - low) / (high - low), 0, 1), 1.0)


def tree_shares(tree: Tree, borders: Sequence[np.ndarray]) -> tuple[float, np.ndarray]:
    """Variance of a tree over the space, and of its mean along each parameter."""
    d = len(borders)
    boxes, values, work = [], [], [(0, np.zeros(d), np.ones(d))]
    while work:
        node, low, high = work.pop()
        f = tree.feature[node]
        if f < 0:
            boxes.append((low, high))
            values.append(tree.value[node])
            continue
        at = borders[f][min(tree.cut[node], len(borders[f]) - 1)]
        left, right = high.copy(), low.copy()
        left[f], right[f] = min(at, high[f]), max(at, low[f])
        work += [(tree.left[node], low, left), (tree.right[node], right, high)]
    low, high = (np.array(side) for side in zip(*boxes))
    size, value = high - low, np.array(values)
    volume = size.prod(axis=1)
    mean = (volume * value).sum()
    whole = (volume * (value - mean) ** 2).sum()
    shares = np.zeros(d)
    for j in range(d):
        cuts = np.unique(np.concatenate([low[:, j], high[:, j], [0.0, 1.0]]))
        others = np.divide(volume, size[:, j], out=np.zeros(len(volume)), where=size[:, j] > 0)
        middle = (cuts[1:] + cuts[:-1]) / 2
        inside = (low[:, j] <= middle[:, None]) & (middle[:, None] < high[:, j])
        along = inside @ (others * value)
        shares[j] = (np.diff(cuts) * (along - mean) ** 2).sum()
    return whole, shares


def variance_importance(trials: DataFrame, space: Mapping[str, tuple] | None = None, trees: int = TREES, seed: int = 42) -> DataFrame:
    """(param, importance): share of the objective's variance that each parameter alone decides, a mean over trees.

    ``space`` gives kinds and bounds as a search has them; without it a parameter ranges over
    its values.  Shares add up to one at most; the rest is what parameters decide together.
    Trials without a value do not count.  Shares are zero if the objective never changes.
    """
    table, names, choices = _encoded(trials, space)
    spark, columns = trials.sparkSession, [f"p{i}" for i in range(len(names))]
    if not names:
        return small_frame(spark, [], "param string, importance double")
    params = {"n_estimators": trees, "min_samples_leaf": 1, "max_features": max(1, -(-5 * len(names) // 6))}
    model: TreesModel = fit_forest(params, table, columns, "value", key="number", seed=seed, max_bins=LEVELS)
    top = table.agg(*[F.max(c).alias(c) for c in columns]).first()
    borders = []
    for i, name in enumerate(names):
        kind, *bounds = space[name] if space and name in space else (None,)
        ends = None
        if kind in ("int", "float", "log"):
            ends = (bounds[0] - 0.5, bounds[1] + 0.5) if kind == "int" else tuple(np.log(bounds)) if kind == "log" else tuple(bounds)
        borders.append(_borders(model.edges[i], top[columns[i]], choices.get(name), ends))
    found = [tree_shares(tree, borders) for tree in model.trees]
    varied = [shares / whole for whole, shares in found if whole > 1e-300]
    mean = np.mean(varied, axis=0) if varied else np.zeros(len(names))
    return small_frame(spark, [(n, float(v)) for n, v in zip(names, mean)], "param string, importance double")
