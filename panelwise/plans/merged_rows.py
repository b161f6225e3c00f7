"""Training rows that trees of binned features cannot tell apart, as one row with their number.

A tree sees of a feature only its bin.  Rows with equal bins, label and weight add the same to
every sum that a split is chosen by, so one row that counts as often does for all of them.
Their number is bounded by the bins, not by the rows.  No row is left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.session import materialize

#: Bins of a feature, as MLlib's trees have them.
BINS = 32
#: Rows from which merging is tried, and how many rows a merged one has to stand for on average.
LEAST_ROWS, LEAST_SHARE = 200_000, 4
#: Column with the number of rows that a merged row stands for.
ROWS = "_rows"
_ACCURACY = 20_000


@dataclass
class Merged:
    """Merged rows: a column of bins per feature, the kept columns, and ``ROWS``."""

    cells: DataFrame
    count: int
    rows: int
    features: list[str]
    edges: list[np.ndarray]

    def bucketizer(self) -> Bucketizer:
        return _bucketizer(self.features, self.edges)


def bin_column(feature: str) -> str:
    return f"_bin_{feature}"


def _bucketizer(features: Sequence[str], edges: Sequence[np.ndarray]) -> Bucketizer:
    """Bins of the features; a value on an edge is in the lower bin, as in a tree."""
    inner = [np.nextafter(e if len(e) else np.zeros(1), np.inf) for e in edges]
    splits = [[-math.inf, *map(float, e[np.isfinite(e)]), math.inf] for e in inner]
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[bin_column(f) for f in features])


def _upper_values(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Largest value of all bins but the last: every value if there are few, else quantiles."""
    shares = [i / BINS for i in range(1, BINS)]
    found = df.agg(
        *[F.approx_count_distinct(f).alias(f"n{j}") for j, f in enumerate(features)],
        *[F.percentile_approx(f, shares, _ACCURACY).alias(f"q{j}") for j, f in enumerate(features)],
    ).first()
    out = []
    for j, f in enumerate(features):
        values = np.array(found[f"q{j}"] or [], float)
        if found[f"n{j}"] <= 2 * BINS:
            few = [r[0] for r in df.select(f).filter(F.col(f).isNotNull()).distinct().limit(BINS + 1).collect()]
            values = np.array(sorted(few)[:-1], float) if len(few) <= BINS else values
        out.append(np.unique(values))
    return out


def _between(ends: dict[int, tuple[float, float]]) -> np.ndarray:
    """Edges half way between the values at both sides, as MLlib puts them."""
    full, out = sorted(ends), []
    for low, high in zip(full, full[1:]):
        a, b = ends[low][1], ends[high][0]
        middle = a / 2 + b / 2
        out.append(middle if a <= middle < b else a)
    return np.array(out, float)


def merge_rows(train: DataFrame, features: Sequence[str], kept: Sequence[str]) -> Merged | None:
    """The rows of ``train`` merged by the bins of ``features`` and the ``kept`` columns.

    None if there are not many rows, or not far fewer merged ones; both are counted first.
    None too if a feature or kept column has missing values, which MLlib's trees refuse.
    """
    rows = train.count()
    if rows < LEAST_ROWS or not features:
        return None
    features = list(features)
    known = [F.col(f).cast("double") for f in features]
    plain = train.select(*[F.when(~F.isnan(c), c).alias(f) for f, c in zip(features, known)], *kept)
    upper = _upper_values(plain, features)
    bins = [bin_column(f) for f in features]
    binned = _bucketizer(features, upper).transform(plain)
    gaps = [F.count_if(F.col(c).isNull()) for c in (*bins, *kept)]
    expected, *missing = binned.agg(F.approx_count_distinct(F.xxhash64(*bins, *kept)), *gaps).first()
    if any(missing) or expected * LEAST_SHARE > rows:
        return None
    ends = [a(f).alias(f"_{n}_{f}") for f in features for n, a in (("low", F.min), ("high", F.max))]
    found = materialize(binned.groupBy(*bins, *kept).agg(F.count(F.lit(1)).cast("double").alias(ROWS), *ends), "merged")
    sides = [F.struct(F.lit(j).alias("j"), F.col(b).alias("bin"), F.col(f"_low_{f}").alias("low"), F.col(f"_high_{f}").alias("high")) for j, (f, b) in enumerate(zip(features, bins))]
    span = found.select(F.inline(F.array(*sides))).groupBy("j", "bin").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    by_feature: list[dict] = [{} for _ in features]
    for r in span.collect():
        by_feature[r["j"]][int(r["bin"])] = (r["low"], r["high"])
    edges = [_between(ends) for ends in by_feature]
    # Bins without rows go, so that bins count as the edges that are left do.
    dense = []
    for b, ends in zip(bins, by_feature):
        places = F.create_map(*[F.lit(float(x)) for i, old in enumerate(sorted(ends)) for x in (old, i)])
        dense.append(places[F.col(b)].alias(b))
    return Merged(found.select(*dense, *kept, ROWS), found.count(), rows, features, edges)
