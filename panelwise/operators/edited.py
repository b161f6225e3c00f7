"""Cleaning by neighbours without listing the neighbours: a join with two radii.

A row stays if its k nearest rows have its label.  That is so exactly if k rows of its
own label come before the nearest row of another label.  So two numbers are enough, and
each bounds the search for the other:

* where the own group of cells holds a row of another label before the k-th own one, only rows
  of the own label are looked at, and only up to that row; too few of them, and the row goes;
* elsewhere only rows of other labels are looked at, up to the k-th own one; none, and the
  row stays;
* the few that are left have both numbers by then, and are counted once more.

Rows that are not up for cleaning are never searched for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwise.operators.neighbours import (
    _VALUES_AT_ONCE,
    MAX_TASKS,
    _best_of_chunk,
    _chunked,
    _cut_pairs,
    _grouped,
    _groups_of,
    _lower_bound,
    _matrix,
    _place,
    _task_rows,
)
from panelwise.session import broadcast_if_small, materialize, small_frame

#: Labels that a table may have; each makes a part of every cell.
MAX_LABELS = 256

_FOUND = "qid bigint, own boolean, distance double, id bigint"


def _groups(df: DataFrame, best: int, row_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Different (vector, label) with their first ``best`` ids, and the rows as they are read."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checked = F.when(values.isNull() | bad, F.raise_error(F.lit("missing or non-finite coordinate")))
    rows = df.select(F.col(row_id).cast("bigint").alias("id"), checked.otherwise(values).alias("vec"), F.col(label).cast("int").alias("label"))
    copies = Window.partitionBy("vec", "label").orderBy("id")
    first = rows.withColumn("_r", F.row_number().over(copies)).filter(F.col("_r") <= best)
    groups = first.groupBy("vec", "label").agg(F.sort_array(F.collect_list("id")).alias("member_ids"))
    return groups.select(F.col("member_ids")[0].alias("gid"), "vec", "label", "member_ids"), rows


def _near(left: pd.DataFrame, right: pd.DataFrame, best: int, own: bool) -> pd.DataFrame:
    """The nearest ``best`` rows of the own label of each query, or of the other labels; within its ``radius``, if given."""
    columns = ["qid", "own", "distance", "id"]
    pieces = []
    right = right.assign(member_labels=right["member_ids"])
    for label, some in left.groupby("qlabel"):
        found = _best_of_chunk(best)(some, right[(right["label"] == label) == own])
        pieces.append(found[["qid", "distance", "id"]].assign(own=own)[columns])
    return pd.concat(pieces) if pieces else pd.DataFrame({c: [] for c in columns})


def _at_home(best: int) -> Callable:
    """The nearest ``best`` own rows, and the nearest row of another label, within one group of cells."""

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        far = _near(left, right, 1, False).drop_duplicates("qid")
        return pd.concat([x for x in (_near(left, right, best, True), far) if len(x)] or [far])

    return search


def _nearest_other(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    return _near(left, right, 1, False).drop_duplicates("qid")


def _count_before(best: int) -> Callable:
    """How many own rows come before (radius, tie), as far as ``best``."""

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        near = _near(left, right, best, True).merge(left[["qid", "radius", "tie"]], on="qid")
        before = (near["distance"] < near["radius"]) | ((near["distance"] == near["radius"]) & (near["id"] < near["tie"]))
        count = near[before].groupby("qid").size().clip(upper=best)
        return pd.DataFrame({"qid": count.index.to_numpy(), "n": count.to_numpy()})

    return search


class _Cells:
    """Parts of cells, one for each cell and label, and the joins of rows with the groups that the cells travel in."""

    def __init__(self, placed: DataFrame, pivots: np.ndarray, labels: list[int], chunk_rows: int):
        self.pivots, self.labels, self.chunk_rows = pivots, labels, chunk_rows
        stats = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("inner"), F.max("away").alias("outer"))
        rows = stats.orderBy("part").collect()
        self.part = np.array([r["part"] for r in rows], np.int64)
        self.inner, self.outer, self.held = (np.array([r[c] for r in rows]) for c in ("inner", "outer", "n"))
        cell = self.part // len(labels)
        held = np.bincount(cell, self.held, len(pivots)).astype(np.int64)
        self.group = _grouped(pivots, held, chunk_rows)
        self.size = {int(g): int(n) for g, n in enumerate(np.bincount(self.group, held))}
        of_cell = [(c, int(g)) for c, g in enumerate(self.group)]
        self.of_cell = F.broadcast(small_frame(placed.sparkSession, of_cell, "cell int, qcell int"))
        self.placed = placed.join(self.of_cell, "cell").select("part", "gid", "vec", "label", "member_ids", F.col("qcell").alias("cell"))
        self.compared = 0

    def join(self, queries: DataFrame, fn: Callable, schema: str) -> DataFrame:
        """``fn`` over each pair of chunks of the queries of a group of cells and its rows."""
        visits = {r["qcell"]: r["count"] for r in queries.groupBy("qcell").count().collect()}
        sizes, pairs = _chunked(self.placed.sparkSession, self.chunk_rows, visits, self.size)
        return _cut_pairs(queries, self.placed, "qcell", sizes, min(max(pairs, 1), MAX_TASKS)).applyInPandas(fn, schema)

    def at_home(self, queries: DataFrame) -> DataFrame:
        """The queries in the group of their cell."""
        self.compared += sum(r["count"] * self.size[self.group[r["cell"]]] for r in queries.groupBy("cell").count().collect())
        return queries.join(self.of_cell, "cell")

    def reached(self, queries: DataFrame, own: bool) -> DataFrame:
        """The queries once for each group of cells, not their own, that may hold a row within ``radius`` of them."""
        part, inner, outer, held, pivots, group = self.part, self.inner, self.outer, self.held, self.pivots, self.group
        cell_of, label_of = np.divmod(part, len(self.labels))

        @F.pandas_udf("to array<int>, pairs bigint")
        def visit(vec: pd.Series, cell: pd.Series, number: pd.Series, radius: pd.Series) -> pd.DataFrame:
            query, mine, limit, label = _matrix(vec), cell.to_numpy(), radius.to_numpy(dtype=float), number.to_numpy()
            to, pairs, step = [], [], max(1, _VALUES_AT_ONCE // len(part))
            for at in range(0, len(query), step):
                e = slice(at, at + step)
                near = _lower_bound(query[e], mine[e], pivots, cell_of, inner, outer) <= limit[e, None]
                near &= (label_of[None, :] == label[e, None]) == own
                near &= group[cell_of][None, :] != group[mine[e]][:, None]
                to += _groups_of(near, group[cell_of])
                pairs.append(near @ held)
            return pd.DataFrame({"to": to, "pairs": np.concatenate(pairs) if pairs else np.zeros(0, np.int64)})

        to = queries.withColumn("_v", visit("qvec", "cell", "number", "radius")).select("*", "_v.*").drop("_v")
        to = materialize(to.filter(F.size("to") > 0), "visits")
        self.compared += to.agg(F.sum("pairs")).first()[0] or 0
        return to.select("*", F.explode("to").alias("qcell")).drop("to", "pairs")


def _before(near: Column, distance: Column, tie: Column) -> Column:
    """Number of (distance, id) in ``near`` that come before the given one."""
    return F.size(F.filter(near, lambda x: (x["distance"] < distance) | ((x["distance"] == distance) & (x["id"] < tie))))


def clean_by_two_radii(
    df: DataFrame,
    clean_labels: Sequence[int],
    k: int = 5,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str = "label",
    chunk_rows: int = 4_096,
    tally: dict | None = None,
) -> DataFrame:
    """The rows that ``enn_clean`` keeps, found with fewer distances.

    A task holds ``chunk_rows`` rows of a side, more of a large table.  Rows of the cleaned labels stay only if all k nearest rows share their label;
    distances count at 6 decimals, ties go to the smaller id.  ``tally`` receives
    the number of distances that the cells leave under ``compared``.
    """
    best = k + 1  # a row is one of its own label's nearest
    found, rows = _groups(df, best, row_id, vector, label)
    labels = [r["label"] for r in rows.select("label").distinct().limit(MAX_LABELS + 1).collect()]
    if None in labels or len(labels) > MAX_LABELS:
        raise ValueError(f"every row needs one of at most {MAX_LABELS} labels")
    wanted = sorted(set(clean_labels) & set(labels))
    if not wanted or len(labels) < 2:
        return df
    labels = sorted(labels)
    index = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")).cast("int") - 1
    groups = materialize(found.withColumn("number", index), "vectors")
    shape = groups.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.min(F.size("vec")).alias("d0")).first()
    if shape["d"] != shape["d0"]:
        raise ValueError("vectors differ in length")
    if shape["n"] <= chunk_rows:
        placed, pivots = groups.withColumns({"cell": F.lit(0), "away": F.lit(0.0)}), np.zeros((1, max(shape["d"], 1)))
    else:
        placed, pivots, _ = _place(groups, shape["n"], max(shape["d"], 1))
    chunk_rows = _task_rows(shape["n"], max(shape["d"], 1), chunk_rows)
    placed = placed.withColumn("part", (F.col("cell") * len(labels) + F.col("number")).cast("int"))
    cells = _Cells(placed, pivots, labels, chunk_rows)

    asked = placed.filter(F.col("label").isin(wanted)).select(
        F.col("gid").alias("qid"), F.col("vec").alias("qvec"), F.col("label").alias("qlabel"), "number", "cell"
    )
    home = cells.join(cells.at_home(asked), _at_home(best), _FOUND)
    near = F.sort_array(F.collect_list(F.when(F.col("own"), F.struct("distance", "id"))))
    other = F.min(F.when(~F.col("own"), F.struct("distance", "id")))
    # Chunks of a large cell each send their best, so only the first ones of all are kept.
    first = home.groupBy("qid").agg(F.slice(near, 1, best).alias("near"), other.alias("other"))
    facts = materialize(asked.join(first, "qid"), "home")
    last = F.when(F.size("near") >= best, F.get("near", F.lit(best - 1)))
    clash = F.col("other").isNotNull() & (last.isNull() | (F.col("other") < last))
    at = (F.col("other.distance"), F.col("other.id"))
    facts = facts.withColumns({"clash": clash, "last": last, "before": _before(F.col("near"), *at)})

    settled = facts.filter("other.distance = 0").select("qid", "before", F.col("other.id").alias("zero"))
    open_ = facts.filter("other IS NULL OR other.distance > 0").withColumn("b", F.col("other"))

    # Clashes at home: rows of the own label up to the clash.
    first_count = materialize(_counted(cells, open_.filter("clash"), best), "clashes")
    gone = first_count.filter(F.col("before") <= k)
    # The others: rows of other labels up to the k-th own one, or up to the clash.
    calm = open_.filter("NOT clash").withColumn("radius", F.coalesce("last.distance", F.lit(float("inf"))))
    late = first_count.filter(F.col("before") > k).withColumn("radius", F.col("b.distance"))
    search = calm.unionByName(late)
    nearer = cells.join(cells.reached(search, own=False), _nearest_other, _FOUND)
    nearer = nearer.groupBy("qid").agg(F.min(F.struct("distance", "id")).alias("out"))
    met = materialize(search.join(nearer, "qid", "left").withColumn("b", F.least("other", "out")), "others")
    again = F.col("b").isNotNull() & F.when(F.col("clash"), F.col("b") < F.col("other")).otherwise(
        F.col("last").isNull() | (F.col("b") < F.col("last"))
    )
    second = met.filter(again).withColumn("before", _before(F.col("near"), F.col("b.distance"), F.col("b.id")))
    gone = gone.select("qid").unionByName(_counted(cells, second, best).filter(F.col("before") <= k).select("qid"))
    verdict = gone.select("qid", F.lit(None).cast("int").alias("before"), F.lit(None).cast("bigint").alias("zero"))
    verdict = materialize(verdict.unionByName(settled), "verdicts")
    if tally is not None:
        tally["compared"] = cells.compared

    marked = groups.join(verdict, groups["gid"] == verdict["qid"]).select("vec", F.col("label").alias("_label"), "before", "zero")
    marked = materialize(marked, "marked")
    owner = rows.join(marked, (rows["vec"] == marked["vec"]) & (rows["label"] == marked["_label"])).select("id", "before", "zero")
    enough = F.col("zero").isNotNull() & (F.col("before") - F.when(F.col("id") < F.col("zero"), 1).otherwise(0) >= k)
    drop = owner.filter(~enough).select(F.col("id").alias("_gone"))
    return df.join(broadcast_if_small(drop), F.col(row_id).cast("bigint") == F.col("_gone"), "left_anti")


def _counted(cells: _Cells, queries: DataFrame, best: int) -> DataFrame:
    """``before`` of the queries with the rows of their label in other cells that come before ``b``."""
    bounded = queries.withColumns({"radius": F.col("b.distance"), "tie": F.col("b.id")})
    counts = cells.join(cells.reached(bounded, own=True), _count_before(best), "qid bigint, n bigint")
    total = counts.groupBy("qid").agg(F.sum("n").alias("n"))
    more = F.col("before") + F.coalesce("n", F.lit(0))
    return queries.join(total, "qid", "left").withColumn("before", more.cast("int")).drop("n")
