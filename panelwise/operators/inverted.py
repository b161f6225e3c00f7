"""Nearest neighbours by an inverted file: k-means cells, several of which each vector probes.

Cells are kept in groups of cells that lie together, and a task holds the members of one
group.  A vector goes once to each group that has one of its nearest cells, not once to
each cell, so a vector is copied as often as there are groups near it.  In the task the
cells are visited one matrix product each; members farther than the best found so far,
and cells whose residuals say that all of theirs are, are left out.

How many cells are probed is the least number that finds the wished share of the true
neighbours of a sample; all cells give the exact neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators.neighbours import (
    _VALUES_AT_ONCE,
    MAX_PIVOT_VALUES,
    MAX_TASKS,
    _best_of_chunk,
    _chunked,
    _cut_pairs,
    _distances,
    _grouped,
    _groups_of,
    _keep_best,
    _matrix,
    _merged,
    _nearest_pivot,
    _per_row,
    _search,
    _task_rows,
    nearest_neighbours,
)
from panelwise.session import materialize, small_frame

#: Vectors that the cells are fitted on, their most cells, and rounds of fitting.
FIT_ROWS, MAX_CELLS, FIT_ROUNDS = 32_768, 4_096, 12
#: Vectors asked to choose the number of probes.
ASKED_ROWS = 400


def _digest_order() -> list:
    return [F.md5(F.col("gid").cast("string").cast("binary")), F.col("gid")]


def _centers(groups: DataFrame, n: int, d: int, cells: int | None, seed: int) -> np.ndarray:
    """Cell centers by k-means on a sample that a digest chooses."""
    count = cells or round(2 * math.sqrt(n))
    count = max(1, min(count, n, MAX_CELLS, MAX_PIVOT_VALUES // d))
    most = min(FIT_ROWS, max(count, 16 * MAX_PIVOT_VALUES // d))
    sample = groups.orderBy(*_digest_order()).limit(most).select("vec").toPandas()
    x = _matrix(sample["vec"])
    centers = x[np.random.default_rng(seed).permutation(len(x))[:count]].copy()
    for _ in range(FIT_ROUNDS):
        cell = _nearest_pivot(x, centers)[0]
        size = np.bincount(cell, minlength=len(centers))
        order = np.argsort(cell, kind="stable")
        filled = np.flatnonzero(size)
        centers[filled] = np.add.reduceat(x[order], (np.cumsum(size) - size)[filled], axis=0) / size[filled, None]
    return centers


def _probe_count(groups: DataFrame, placed: DataFrame, centers: np.ndarray, n: int, k: int, recall: float, chunk_rows: int) -> int:
    """Fewest cells, nearest first, that hold ``recall`` of the true neighbours of asked vectors with two standard errors to spare."""
    if recall >= 1 or len(centers) == 1:
        return len(centers)
    drawn = groups.orderBy(*_digest_order()).limit(ASKED_ROWS)
    drawn = materialize(drawn.select(F.col("gid").alias("qid"), F.col("vec").alias("qvec"), F.lit(0).alias("qcell")), "asked")
    single = groups.select(
        "gid", "vec", F.array("gid").alias("member_ids"), F.array(F.lit(0)).alias("member_labels"), F.lit(0).alias("cell")
    )
    true = _keep_best(_search(drawn, single, k + 1, chunk_rows, {0: ASKED_ROWS}, {0: n}), k + 1).filter("qid <> id")
    cells = true.join(placed.select(F.col("gid").alias("id"), "cell"), "id").join(drawn.select("qid", "qvec"), "qid")
    found = cells.select("qid", "qvec", "cell").toPandas()
    if not len(found):
        return 1
    asked = found.groupby("qid", sort=True)
    vectors = _matrix(asked["qvec"].first())
    place = np.argsort(np.argsort(_distances(vectors, centers), axis=1, kind="stable"), axis=1)
    owner = asked.ngroup().to_numpy()
    needed = place[owner, found["cell"].to_numpy()]
    count = np.bincount(owner)
    share = np.stack([np.bincount(owner, needed < p, len(count)) / count for p in range(1, len(centers) + 1)])
    spare = 2 * np.sqrt((share.var(axis=1) + 1 / len(count)) / len(count))
    enough = np.flatnonzero(share.mean(axis=1) - spare >= recall)
    return int(enough[0]) + 1 if len(enough) else len(centers)


def inverted_neighbours(
    df: DataFrame,
    k: int,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str | None = None,
    recall: float = 0.9,
    cells: int | None = None,
    group_rows: int = 16_384,
    chunk_rows: int = 8_192,
    seed: int = 42,
) -> DataFrame:
    """Like ``nearest_neighbours``, among the members of the cells each vector probes; for large n.

    ``recall`` is the share of true neighbours to be found, measured on a sample of
    the vectors; 1 gives the exact neighbours.  Without ``cells`` there are twice the
    root of the number of vectors, at most ``MAX_CELLS``.  Tasks hold at most about
    ``group_rows`` members and ``chunk_rows`` vectors that probe them, more of a large table
    (``_task_rows``); a cell with more members is cut.  Equal vectors are searched once.  A row may have fewer than k
    neighbours if few rows are in its cells.
    """
    best = k + 1
    groups, rows = _merged(df, best, row_id, vector, label)
    shape = groups.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.min(F.size("vec")).alias("d0")).first()
    if not shape["n"] or not shape["d"]:
        return nearest_neighbours(df, k, row_id, vector, label)
    if shape["d"] != shape["d0"]:
        raise ValueError("vectors differ in length")
    centers = _centers(groups, shape["n"], shape["d"], cells, seed)

    @F.pandas_udf("cell int, away double")
    def home(vec: pd.Series) -> pd.DataFrame:
        cell, away = _nearest_pivot(_matrix(vec), centers)
        return pd.DataFrame({"cell": cell.astype("int32"), "away": away})

    placed = materialize(groups.withColumn("_at", home("vec")).select("*", "_at.cell", "_at.away").drop("_at"), "cells")
    known = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    sizes = np.array([known.get(c, 0) for c in range(len(centers))])
    probes = _probe_count(groups, placed, centers, shape["n"], k, recall, chunk_rows)
    most = max(group_rows, _task_rows(shape["n"], shape["d"], chunk_rows))
    group = _grouped(centers, sizes, most)
    held = np.bincount(group, sizes).astype(np.int64)
    filled = np.flatnonzero(sizes)

    @F.pandas_udf("reach double, to array<int>")
    def visits(vec: pd.Series) -> pd.DataFrame:
        query = _matrix(vec)
        reach, to, step = np.full(len(query), np.inf), [], max(1, _VALUES_AT_ONCE // len(centers))
        for at in range(0, len(query), step):
            e = slice(at, at + step)
            away = _distances(query[e], centers)
            if probes < len(centers):
                reach[e] = np.partition(away, probes - 1, axis=1)[:, probes - 1]
            to += _groups_of(away[:, filled] <= reach[e, None], group[filled])
        return pd.DataFrame({"reach": reach, "to": to})

    asked = placed.select(F.col("gid").alias("qid"), F.col("vec").alias("qvec"), visits("vec").alias("_v"))
    # Read twice, to size the chunks and to search; written before the groups multiply the vectors.
    asked = materialize(asked.select("qid", "qvec", "_v.reach", "_v.to"), "probes")
    asked = asked.select("qid", "qvec", "reach", F.explode("to").alias("qcell"))
    spark = df.sparkSession
    of_cell = F.broadcast(small_frame(spark, [(c, int(g)) for c, g in enumerate(group)], "part int, cell int"))
    base = placed.withColumnRenamed("cell", "part").join(of_cell, "part")
    base = base.select("gid", "vec", "cell", "part", "member_ids", "member_labels")
    visited = {r["qcell"]: r["count"] for r in asked.groupBy("qcell").count().collect()}
    sizes_of, pairs = _chunked(spark, most, visited, dict(enumerate(held)))
    found = _cut_pairs(asked, base, "qcell", sizes_of, min(max(pairs, 1), MAX_TASKS)).applyInPandas(
        _best_of_chunk(best, centers), "qid bigint, distance double, id bigint, label int"
    )
    return _per_row(_keep_best(found, best), groups, rows, shape["n"], k, row_id)
