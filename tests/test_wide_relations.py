from __future__ import annotations

import numpy as np
import pytest

from panelwise.operators import relations, wide_relations


def table(spark, n, d, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + 1000 * rng.normal(size=d)
    x[:, 1::3] += x[:, 0::3][:, : x[:, 1::3].shape[1]]
    x[rng.random((n, d)) < 0.1] = np.nan
    x[0, 0] = np.inf
    if d > 4:
        x[:, 4] = 7.25
    names = [f"c{i}" for i in range(d)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3), names


def found(pairs):
    return {(r["feature_a"], r["feature_b"]): r["corr"] for r in pairs.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) < 1e-9), k


@pytest.mark.parametrize("block,task_bytes", [(256, 64 << 20), (4, 1), (5, 4000)])
def test_blocks_give_the_pairs_of_the_whole_matrix(spark, block, task_bytes):
    df, names = table(spark, 150, 13)
    same(found(wide_relations.correlation_pairs_wide(df, names, block, task_bytes)), found(relations.correlation_pairs(df, names)))


def test_many_columns(spark):
    """2,000 columns: two passes, no task with more than the stated bytes of sums; a sample of pairs against numpy."""
    rng = np.random.default_rng(3)
    names = [f"c{i}" for i in range(2000)]
    values = spark.range(60).selectExpr(*[f"sin(id * {i % 97 + 1}) + cos(id * id + {i}) AS c{i}" for i in range(2000)])
    assert wide_relations.passes_needed(2000) == 2
    pairs = wide_relations.correlation_pairs_wide(values, names)
    assert pairs.count() == 2000 * 1999 // 2
    want = np.abs(np.corrcoef(values.toPandas().to_numpy().T))
    for r in pairs.filter("hash(feature_a, feature_b) % 5000 = 0").collect():
        assert abs(r["corr"] - want[int(r["feature_a"][1:]), int(r["feature_b"][1:])]) < 1e-9


def test_pruning_and_odd_tables(spark):
    df, names = table(spark, 120, 9, seed=2)
    kept, left = relations.correlation_prune(df, names, 0.5)
    kept_wide, left_wide = wide_relations.correlation_prune_wide(df, names, 0.5, block=3)
    assert kept == kept_wide
    same(found(left_wide), found(left))
    empty = wide_relations.correlation_pairs_wide(df.limit(0), names)
    same(found(empty), found(relations.correlation_pairs(df.limit(0), names)))
    assert wide_relations.correlation_pairs_wide(df, names[:1]).count() == 0
