"""Decision trees grown from histograms of gradients and curvatures.

Features are cut into bins at quantiles, once.  A level of a tree is one pass over the
binned rows: every task adds up gradient, curvature and number of its rows per open node,
feature and bin, the sums of tasks are added by Spark, and running sums over the bins give
each node's best split there.  Only that split reaches the driver.

The same builder makes boosted trees of second order, whose penalties act on the weight of
a leaf as they are (L1 and L2 on the weight, a least gain per split), and random forests:
with the weighted label as gradient and the weight as curvature, the gain is the loss of
impurity and the weight of a leaf is the share of its positives.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwise.plans.merged_rows import ROWS, Merged, bin_column
from panelwise.session import materialize, small_frame

#: Bins of a feature, nodes whose histograms a pass adds up, trees after which margins are written.
MAX_BINS, NODES_AT_ONCE, TREES_KEPT = 128, 256, 8
#: Nodes that a pass over merged rows adds up, and the bytes that their sums may have in a task.
MERGED_NODES, MERGED_BYTES = 2_048, 64 << 20
#: Mean from which a number of draws is taken from the expansion of its distribution about the normal one.
_MANY = 64
#: Most nodes of a tree whose rows are told apart by masks of whole columns.
NODES_AS_MASKS = 31
_GAIN_DECIMALS = 9
_U = np.uint64


@dataclass
class Rules:
    """What a split and a leaf must be like."""

    depth: int = 6
    alpha: float = 0.0
    lambda_: float = 1.0
    gamma: float = 0.0
    least_curvature: float = 0.0
    least_leaf: int = 1
    least_split: int = 2
    rate: float = 1.0

    def leaf(self, g: float, h: float) -> float:
        shrunk = math.copysign(max(abs(g) - self.alpha, 0.0), g)
        return -self.rate * shrunk / (h + self.lambda_) if h + self.lambda_ > 0 else 0.0

    def score(self, g: Column, h: Column) -> Column:
        shrunk = F.greatest(F.abs(g) - F.lit(self.alpha), F.lit(0.0))
        return F.when(h + self.lambda_ > 0, shrunk * shrunk / (h + self.lambda_)).otherwise(0.0)


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has no feature."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    facts: list[tuple] = field(default_factory=lambda: [(0.0, 0.0, 0)])
    level: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float) -> None:
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, cut, missing_left, gain
        for side in (self.left, self.right):
            side[node] = len(self.feature)
            for values, empty in (
                (self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, -1), (self.right, -1),
                (self.value, 0.0), (self.gain, 0.0), (self.facts, (0.0, 0.0, 0)), (self.level, self.level[node] + 1),
            ):
                values.append(empty)

    def leaf_of(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """Node that each row ends in; ``missing`` is the bin that stands for no value, per feature."""
        if len(self.feature) <= NODES_AS_MASKS:
            return self._below(0, bins, missing)
        node = np.zeros(len(bins), np.int64)
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right, none = np.array(self.left), np.array(self.right), np.array(self.missing_left)
        for _ in range(max(self.level)):
            at = np.flatnonzero(feature[node] >= 0)
            if not len(at):
                break
            n = node[at]
            f = feature[n]
            b = bins[at, f]
            goes = np.where(b == missing[f], none[n], b <= cut[n])
            node[at] = np.where(goes, left[n], right[n])
        return node

    def _below(self, node: int, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """Nodes of few, each side chosen for whole columns: no row is looked up by its number."""
        f = self.feature[node]
        if f < 0:
            return np.full(len(bins), node, np.int64)
        b = bins[:, f]
        goes = b <= self.cut[node]
        if self.missing_left[node]:
            goes |= b == missing[f]
        else:
            goes &= b != missing[f]
        return np.where(goes, self._below(self.left[node], bins, missing), self._below(self.right[node], bins, missing))


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper edges of all bins but the last of each feature: every value if there are few, else quantiles."""
    known = df.select(*[F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f) for f in features])
    counts = known.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    shares = [i / max_bins for i in range(1, max_bins)]
    wide = [f for f in features if counts[f] > 0.8 * max_bins]
    found = known.agg(*[F.percentile_approx(f, shares, 20_000).alias(f) for f in wide]).first() if wide else {}
    out = []
    for f in features:
        if f in wide:
            edges = np.unique(np.array(found[f] or [], float))
        else:
            values = known.select(f).filter(F.col(f).isNotNull()).distinct().limit(max_bins).collect()
            edges = np.array(sorted(r[0] for r in values)[:-1], float)
        out.append(edges)
    return out


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value, a column per feature; no value has the bin after the last."""
    out = np.empty(values.shape, np.int16)
    for j, cuts in enumerate(edges):
        column = values[:, j]
        out[:, j] = np.where(np.isnan(column), len(cuts) + 1, np.searchsorted(cuts, column, side="left"))
    return out


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) drawn from keys and a salt."""
    with np.errstate(over="ignore"):
        x = keys.astype(_U) + _U((0x9E3779B97F4A7C15 * (2 * salt + 1)) % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> _U(shift))) * _U(factor)
        return ((x ^ (x >> _U(31))) >> _U(11)).astype(float) / float(1 << 53)


def _poisson(u: np.ndarray) -> np.ndarray:
    """How often a row is drawn with replacement, from a uniform number: Poisson of mean one."""
    chances = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(chances, u).astype(float)


def _drawn(keys: np.ndarray, salt: int, rows: np.ndarray) -> np.ndarray:
    """How often the rows that a merged row stands for are drawn: Poisson of their number, as the sum of single draws is.

    Up to a mean of ``_MANY`` by the exact distribution, above by its expansion about the normal one.
    """
    u = _uniform(keys, salt)
    out = np.empty(len(rows))
    for n in np.unique(rows[rows <= _MANY]):
        here = rows == n
        chances = np.cumsum([math.exp(k * math.log(n) - n - math.lgamma(k + 1)) for k in range(int(n + 12 * math.sqrt(n) + 12))])
        out[here] = np.searchsorted(chances, u[here])
    big = rows > _MANY
    n, angle = rows[big], _uniform(keys[big], salt ^ (1 << 40))
    z = np.sqrt(-2 * np.log1p(-u[big])) * np.cos(2 * math.pi * angle)
    out[big] = np.maximum(np.rint(n + np.sqrt(n) * z + (z * z - 1) / 6), 0)
    return out


class Grower:
    """Binned rows on the cluster, and passes over them that grow trees."""

    #: Nodes whose histograms a pass adds up, and whether a row stands for several.
    nodes_at_once, merged = NODES_AT_ONCE, False

    @classmethod
    def over(cls, merged: Merged, label: str, weight: str, rules: Rules, seed: int) -> Grower:
        """Merged rows in place of binned ones."""
        self = cls.__new__(cls)
        self.features, self.rules, self.seed, self.merged = list(merged.features), rules, seed, True
        self.edges = merged.edges
        self.missing = np.array([len(e) + 1 for e in self.edges], np.int64)
        width = len(self.features) * (int(self.missing.max()) + 1) * 24
        self.nodes_at_once = max(1, min(MERGED_NODES, MERGED_BYTES // width))
        bins = [F.col(bin_column(f)).cast("smallint") for f in self.features]
        self.rows = materialize(
            merged.cells.select(
                F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"),
                F.xxhash64(*bins, label).alias("key"), F.array(*bins).alias("bins"), F.lit(0.0).alias("margin"), F.col(ROWS).alias("rows"),
            ),
            "cells",
        )
        return self

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, key: str | None, weight: str | None, rules: Rules, seed: int, max_bins: int):
        self.features, self.rules, self.seed = list(features), rules, seed
        self.edges = bin_edges(df, features, max_bins)
        self.missing = np.array([len(e) + 1 for e in self.edges], np.int64)
        edges = self.edges

        @F.pandas_udf("array<smallint>")
        def bins(*columns: pd.Series) -> pd.Series:
            return pd.Series(list(binned(np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns], axis=1), edges)))

        keyed = F.xxhash64(F.col(key)) if key else F.xxhash64(*[F.col(c) for c in df.columns])
        self.rows = materialize(
            df.select(
                F.col(label).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
                keyed.alias("key"), bins(*[F.col(f).cast("double") for f in features]).alias("bins"), F.lit(0.0).alias("margin"),
            ),
            "binned",
        )

    def advance(self, trees: Sequence[Tree]) -> None:
        """Add the trees to the rows' margins and write them."""
        trees, missing = list(trees), self.missing

        @F.pandas_udf("double")
        def after(bins: pd.Series, margin: pd.Series) -> pd.Series:
            return margin + _sum_of(trees, np.stack(bins.to_numpy()), missing)

        self.rows = materialize(self.rows.withColumn("margin", after("bins", "margin")), "margins")

    def histograms(self, open_: list[tuple[int, int]], trees: Sequence[Tree], recent: Sequence[Tree], boosted: bool, salts: Sequence[int], share: float) -> DataFrame:
        """(node, feature, bin, g, h, n): sums over the rows in each open (tree, node), numbered in order.

        Boosted trees take gradient and curvature of the logistic loss at the margin and
        the recent trees, from a ``share`` of the rows; others draw rows with replacement.
        """
        missing, d = self.missing, len(self.features)
        width = int(missing.max()) + 1
        by_tree: dict[int, dict[int, int]] = {}
        for number, (tree, node) in enumerate(open_):
            by_tree.setdefault(tree, {})[node] = number
        work_trees = {t: trees[t] for t in by_tree}
        recent, salts, merged = list(recent), list(salts), self.merged

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((3, len(open_), d, width))
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
                keys = batch.column("key").to_numpy().view(_U)
                bins = np.asfortranarray(batch.column("bins").flatten().to_numpy().reshape(-1, d), np.int64)
                if boosted:
                    margin = batch.column("margin").to_numpy() + _sum_of(recent, bins, missing)
                    p = 1 / (1 + np.exp(-margin))
                    g, h = w * (p - y), w * p * (1 - p)
                else:
                    g, h = -w * y, w
                for t, nodes in by_tree.items():
                    number = np.full(len(work_trees[t].feature), -1)
                    number[list(nodes)] = list(nodes.values())
                    at = number[work_trees[t].leaf_of(bins, missing)]
                    if merged:
                        times = _drawn(keys, salts[t], batch.column("rows").to_numpy())
                    else:
                        u = _uniform(keys, salts[t])
                        times = (u < share).astype(float) if boosted else _poisson(u)
                    some = np.flatnonzero((at >= 0) & (times > 0))
                    place, added = at[some] * width, [(v * times)[some] for v in (g, h)] + [times[some]]
                    for j in range(d):
                        cell = place + bins[some, j]
                        for k, v in enumerate(added):
                            sums[k, :, j] += np.bincount(cell, v, len(open_) * width).reshape(-1, width)
            sums = sums.reshape(3, -1)
            full = np.flatnonzero(sums[2])
            columns = [full // (d * width), full // width % d, full % width]
            arrays = [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(s[full]) for s in sums]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "feature", "bin", "g", "h", "n"])

        rows = self.rows.select("y", "w", "key", "bins", "margin", *(["rows"] if merged else []))
        found = rows.mapInArrow(work, "node int, feature int, bin int, g double, h double, n double")
        return found.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))

    def best_splits(self, sums: DataFrame, allowed: DataFrame | None) -> DataFrame:
        """Sums and best split of each node: node, tg, th, tn, feature, bin, missing_left, gain (null if none will do), left_g, left_h, left_n."""
        rules, spark = self.rules, sums.sparkSession
        none = F.broadcast(small_frame(spark, [(j, int(m)) for j, m in enumerate(self.missing)], "feature int, none int"))
        cells = sums.join(none, "feature").withColumn("gap", F.col("bin") == F.col("none"))
        whole = Window.partitionBy("node", "feature")
        upto = whole.orderBy("gap", "bin").rowsBetween(Window.unboundedPreceding, 0)
        for c in ("g", "h", "n"):
            cells = cells.withColumns({
                f"t{c}": F.sum(c).over(whole), f"m{c}": F.sum(F.when(F.col("gap"), F.col(c)).otherwise(0.0)).over(whole), f"l{c}": F.sum(c).over(upto),
            })
        options = cells.filter("NOT gap").withColumn("missing_left", F.explode(F.array(F.lit(False), F.lit(True))))
        left = {c: F.col(f"l{c}") + F.when(F.col("missing_left"), F.col(f"m{c}")).otherwise(0.0) for c in ("g", "h", "n")}
        right = {c: F.col(f"t{c}") - left[c] for c in left}
        fits = (F.col("tn") >= rules.least_split) & (F.lit(rules.depth) > 0)
        for side in (left, right):
            fits = fits & (side["n"] >= max(rules.least_leaf, 1)) & (side["h"] >= rules.least_curvature)
        gain = rules.score(left["g"], left["h"]) + rules.score(right["g"], right["h"]) - rules.score(F.col("tg"), F.col("th"))
        gain = F.round(gain, _GAIN_DECIMALS)
        options = options.withColumn("gain", F.when(fits & (gain > 10.0**-_GAIN_DECIMALS) & (gain >= rules.gamma), gain))
        if allowed is not None:
            options = options.join(F.broadcast(allowed), ["node", "feature"], "left")
            options = options.withColumn("gain", F.when(F.col("may").isNotNull(), F.col("gain")))
        rank = F.struct(F.coalesce("gain", F.lit(-1.0)), -F.col("feature"), -F.col("bin"), ~F.col("missing_left"))
        sums_left = [left[c].alias(f"left_{c}") for c in ("g", "h", "n")]
        chosen = F.struct("feature", "bin", "missing_left", "gain", *sums_left)
        totals = cells.groupBy("node").agg(F.min_by(F.struct("tg", "th", "tn"), "feature").alias("t"))
        best = options.groupBy("node").agg(F.max_by(chosen, rank).alias("b"))
        return totals.join(best, "node", "left").select("node", "t.*", "b.*")

    def grow(self, trees: list[Tree], salts: Sequence[int], boosted: bool, recent: Sequence[Tree] = (), share: float = 1.0, tried=None) -> None:
        """Grow all trees level by level; ``tried(tree, node)`` names the features that a node may split by."""
        open_ = [(t, 0) for t in range(len(trees))]
        while open_:
            following = []
            for start in range(0, len(open_), self.nodes_at_once):
                now = open_[start : start + self.nodes_at_once]
                sums = self.histograms(now, trees, recent, boosted, salts, share)
                may = None
                if tried is not None:
                    pairs = [(i, int(f), 1) for i, (t, node) in enumerate(now) for f in tried(t, node)]
                    may = small_frame(self.rows.sparkSession, pairs, "node int, feature int, may int")
                found = self.best_splits(sums, may).collect()
                for r in sorted(found, key=lambda r: r["node"]) if self.merged else found:
                    t, node = now[r["node"]]
                    tree = trees[t]
                    self._settle(tree, node, r["tg"], r["th"], r["tn"])
                    if r["gain"] is None:
                        continue
                    tree.split(node, r["feature"], r["bin"], r["missing_left"], r["gain"])
                    sides = (r["left_g"], r["left_h"], r["left_n"])
                    for child, (g, h, n) in ((tree.left[node], sides), (tree.right[node], [r[k] - v for k, v in zip(("tg", "th", "tn"), sides)])):
                        self._settle(tree, child, g, h, n)
                        if tree.level[child] < self.rules.depth and n >= max(self.rules.least_split, 2 * self.rules.least_leaf):
                            following.append((t, child))
            open_ = following

    def _settle(self, tree: Tree, node: int, g: float, h: float, n: float) -> None:
        tree.facts[node], tree.value[node] = (g, h, n), self.rules.leaf(g, h)


def _sum_of(trees: Sequence[Tree], bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
    total = np.zeros(len(bins))
    for tree in trees:
        total += np.array(tree.value)[tree.leaf_of(bins, missing)]
    return total


class TreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; ``transform`` adds the vector column ``probability``.

    What was learned is a JSON parameter, so pipelines with trees are saved and loaded like any other.
    ``even`` gives each tree the same part in the importance of features, as MLlib's forests do.
    """

    learned = Param(Params._dummy(), "learned", "fitted trees", TypeConverters.toString)

    def __init__(self, features: Sequence[str] = (), edges: Sequence[np.ndarray] = (), trees: Sequence[Tree] = (), boosted: bool = False, base: float = 0.0, even: bool = False):
        super().__init__()
        self._keep(features, edges, trees, boosted, base, even)
        if trees:
            document = [self.features, [e.tolist() for e in self.edges], [asdict(t) for t in trees], boosted, base, even]
            self._set(learned=json.dumps(document, default=lambda x: x.item()))

    def _keep(self, features, edges, trees, boosted, base, even) -> None:
        self.features, self.edges, self.trees = list(features), [np.array(e, float) for e in edges], list(trees)
        self.boosted, self.base, self.even = boosted, base, even
        self.missing = np.array([len(e) + 1 for e in self.edges], np.int64)

    def set(self, param: Param, value: Any) -> None:
        """A model that is read back gets its trees here."""
        super().set(param, value)
        if param.name == "learned" and not self.trees:
            features, edges, trees, *rest = json.loads(value)
            self._keep(features, edges, [Tree(**t) for t in trees], *rest)

    def _transform(self, df: DataFrame) -> DataFrame:
        edges, trees, missing, boosted, base = self.edges, self.trees, self.missing, self.boosted, self.base

        @F.pandas_udf("double")
        def chance(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns], axis=1)
            total = _sum_of(trees, binned(x, edges).astype(np.int64), missing)
            return pd.Series(1 / (1 + np.exp(-(base + total))) if boosted else np.clip(total / max(len(trees), 1), 0, 1))

        p = chance(*[F.col(f).cast("double") for f in self.features])
        return df.withColumn("_chance", p).withColumn("probability", array_to_vector(F.array(1 - F.col("_chance"), F.col("_chance")))).drop("_chance")

    @property
    def featureImportances(self):
        """Share of the gain of all splits that each feature has."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            gains = np.zeros(len(self.features))
            np.add.at(gains, [f for f in tree.feature if f >= 0], [g for f, g in zip(tree.feature, tree.gain) if f >= 0])
            total += gains / gains.sum() if self.even and gains.sum() else gains
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, left, right, feature, threshold, missing_left, gain, gradient, curvature, rows, value): every node."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, f in enumerate(tree.feature):
                inner = f >= 0
                threshold = float(self.edges[f][tree.cut[i]]) if inner and tree.cut[i] < len(self.edges[f]) else None
                rows.append((
                    t, i, tree.left[i] if inner else None, tree.right[i] if inner else None, self.features[f] if inner else None, threshold,
                    tree.missing_left[i] if inner else None, tree.gain[i] if inner else None, *map(float, tree.facts[i]), tree.value[i],
                ))
        schema = (
            "tree int, node int, left int, right int, feature string, threshold double, missing_left boolean, gain double, "
            "gradient double, curvature double, rows double, value double"
        )
        return small_frame(spark, rows, schema)


def _count(value: Any, d: int) -> int:
    names = {"sqrt": math.sqrt(d), "log2": math.log2(max(d, 1))}
    return max(1, min(d, int(names.get(value, d))))


def fit_boosting(params: Mapping[str, Any], df: DataFrame, features: Sequence[str], label: str, key: str | None = None, seed: int = 42, max_bins: int = MAX_BINS) -> TreesModel:
    """Boosting of second order with the logistic loss.

    ``n_estimators``, ``max_depth``, ``learning_rate``, ``subsample``, ``colsample_bytree`` and
    ``min_child_weight`` (1, of curvature); ``reg_alpha`` and ``reg_lambda`` (1) shrink a leaf's
    weight, ``gamma`` is the least gain of a split.  Missing values go where the gain is larger.
    Rows and features are drawn from digests of ``key`` (else the whole row) and tree number.
    """
    rules = Rules(
        depth=int(params.get("max_depth", 6)), alpha=float(params.get("reg_alpha", 0.0)), lambda_=float(params.get("reg_lambda", 1.0)),
        gamma=float(params.get("gamma", 0.0)), least_curvature=float(params.get("min_child_weight", 1.0)), rate=float(params.get("learning_rate", 0.3)),
    )
    grower = Grower(df, features, label, key, None, rules, seed, max_bins)
    d, trees, recent = len(features), [], []
    for number in range(int(params.get("n_estimators", 100))):
        rng = np.random.default_rng((seed, number))
        some = rng.permutation(d)[: max(1, math.ceil(d * float(params.get("colsample_bytree", 1.0))))].tolist()
        tree = Tree()
        grower.grow([tree], [seed * 1_000_003 + number], True, recent, float(params.get("subsample", 1.0)), (lambda t, n: some) if len(some) < d else None)
        trees.append(tree)
        recent.append(tree)
        if len(recent) == TREES_KEPT:
            grower.advance(recent)
            recent = []
    return TreesModel(features, grower.edges, trees, True)


def fit_forest(
    params: Mapping[str, Any], df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, key: str | None = None, seed: int = 42, max_bins: int = MAX_BINS
) -> TreesModel:
    """A forest of trees that lower the impurity of the weighted labels.

    ``n_estimators``, ``max_depth`` (none: as deep as rows allow), ``max_features`` (``sqrt``, ``log2`` or all),
    ``min_samples_leaf`` and ``min_samples_split`` count the rows drawn for a tree.  Trees are grown together.
    """
    rules = Rules(
        depth=int(params.get("max_depth") or 64), lambda_=0.0, least_leaf=int(params.get("min_samples_leaf", 1)),
        least_split=int(params.get("min_samples_split", 2)),
    )
    grower = Grower(df, features, label, key, weight, rules, seed, max_bins)
    trees = _grow_forest(grower, params, _count(params.get("max_features", "sqrt"), len(features)))
    return TreesModel(features, grower.edges, trees, False)


def _grow_forest(grower: Grower, params: Mapping[str, Any], many: int) -> list[Tree]:
    seed, d = grower.seed, len(grower.features)
    trees = [Tree() for _ in range(int(params.get("n_estimators", 100)))]

    def tried(t: int, node: int) -> list[int]:
        return np.random.default_rng((seed, t, node)).permutation(d)[:many].tolist()

    grower.grow(trees, [seed * 1_000_003 + t for t in range(len(trees))], False, tried=tried if many < d else None)
    return trees


def fit_merged_forest(params: Mapping[str, Any], merged: Merged, label: str, weight: str, depth: int, seed: int = 42) -> TreesModel:
    """The forest of ``fit_forest`` from merged rows, each drawn as often as the rows it stands for would be.

    Bins, number of tried features and importances are those of MLlib's forests.
    """
    rules = Rules(depth=depth, lambda_=0.0, least_leaf=int(params.get("min_samples_leaf", 1)))
    grower, d = Grower.over(merged, label, weight, rules, seed), len(merged.features)
    tried = {"sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d)))}
    trees = _grow_forest(grower, params, tried.get(params.get("max_features", "sqrt"), d))
    return TreesModel(merged.features, grower.edges, trees, False, even=True)
