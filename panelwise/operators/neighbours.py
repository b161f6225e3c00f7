"""Exact k nearest neighbours by Euclidean distance, as a partitioned join.

Points are put into cells around pivots.  Every point first looks for its
neighbours in its own cell; that gives a radius, and only cells that can hold
something closer are visited next (triangle inequality; Lu, Shen, Chen, Ooi,
"Efficient Processing of k Nearest Neighbor Joins using MapReduce", VLDB 2012).
Cells that lie together travel as one group, so that a point is copied once for
each group near it and not once for each cell; the task searches the cells of a
group in turn.  In few dimensions the groups are boxes instead, found by cuts of single
coordinates, and a task searches small boxes of its points.  Groups are cut into chunks, so that no task sees more than a fixed
number of points on either side, and tasks return only the best few candidates per
point.
Equal vectors are merged before the search: each is searched once, whatever
the number of its copies.

Distances count at 6 decimals and ties go to the smaller id, so the result does
not depend on the order of floating point sums.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwise.session import materialize, small_frame

DECIMALS = 6
_SLACK = 1e-6
# Pairs computed exactly at once; values of a matrix held at once; points of a cell compared at once.
_PAIRS_AT_ONCE, _VALUES_AT_ONCE, _RUN = 50_000, 1 << 21, 2_048
# A side of a task: a share of all points, bounded in points and in coordinates; most tasks of a search.
SHARES, MAX_TASK_ROWS, MAX_TASK_VALUES, MAX_TASKS = 8, 1 << 16, 1 << 22, 4_096
# Pivots are sent to every task; this bounds their number of coordinates.
MAX_PIVOT_VALUES = 1 << 20
MAX_PIVOTS = 4_096
# Dimensions up to which boxes take the place of cells; sampled vectors per box; points of a small box of a task.
LOW_DIMENSIONS, _BOX_SAMPLE, _BLOCK = 8, 64, 64


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(float) if len(series) else np.empty((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances by one matrix product; good to about 1e-7 of the vector length."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Allowance for the error of ``_distances``, per row of ``a``."""
    scale = np.sqrt((a * a).sum(1)) + (np.sqrt((b * b).sum(1)).max() if len(b) else 0.0)
    return _SLACK * (1.0 + scale)


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each row and its distance, some rows at a time."""
    cell, away = np.empty(len(x), np.int64), np.empty(len(x))
    step = max(1, _VALUES_AT_ONCE // len(pivots))
    for start in range(0, len(x), step):
        part = _distances(x[start : start + step], pivots)
        cell[start : start + step] = part.argmin(axis=1)
        away[start : start + step] = part.min(axis=1)
    return cell, away


def _task_rows(n: int, d: int, least: int) -> int:
    """Points of a side that a task holds: ``least`` or a share of all, as far as memory goes."""
    return max(least, min(math.ceil(n / SHARES), MAX_TASK_ROWS, MAX_TASK_VALUES // max(d, 1)))


def _grouped(centers: np.ndarray, sizes: np.ndarray, group_rows: int) -> np.ndarray:
    """Group of each cell: cells are halved across their widest direction until a half has few enough members."""
    group, work, number = np.zeros(len(centers), np.int64), [np.arange(len(centers))], 0
    while work:
        cells = work.pop()
        if sizes[cells].sum() <= group_rows or len(cells) == 1:
            group[cells], number = number, number + 1
            continue
        spread = centers[cells] - centers[cells].mean(axis=0)
        side = spread @ np.linalg.svd(spread, full_matrices=False)[2][0]
        order = np.argsort(side, kind="stable")
        half = np.searchsorted(np.cumsum(sizes[cells][order]), sizes[cells].sum() / 2)
        half = min(max(int(half), 1), len(cells) - 1)
        work += [cells[order[:half]], cells[order[half:]]]
    return group


class _Nearest:
    """The best few points of every query, found block by block.

    A matrix product, in single precision where there are many dimensions, rules out
    most pairs: those farther than the best found so far by more than its error.  The
    others are computed exactly.
    """

    def __init__(self, query: np.ndarray, base: np.ndarray, ids: np.ndarray, best: int, radius: np.ndarray | None):
        self.query, self.base, self.ids, self.best = query, base, ids, best
        kind = np.float32 if query.shape[1] >= 16 else np.float64
        middle = base.mean(axis=0)
        self.q, self.b = query - middle, base - middle
        self.square, square = (self.q**2).sum(1), (self.b**2).sum(1)
        # The product q.b - b.b/2 orders the points of a query by their distance.
        self.q = np.hstack([self.q, np.ones((len(query), 1))]).astype(kind)
        self.b = np.hstack([self.b, -square[:, None] / 2]).astype(kind)
        length = np.sqrt(self.square) + math.sqrt(square.max())
        self.slack = 2 * (query.shape[1] + 8) * np.finfo(kind).eps * length**2
        self.limit = np.full(len(query), np.inf) if radius is None else radius.astype(float)
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.new = 0

    def look(self, rows: np.ndarray, start: int, stop: int) -> None:
        """Compare the queries ``rows`` with the points from ``start`` to ``stop``."""
        step = max(1, _VALUES_AT_ONCE // (stop - start))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            near = self.q[some] @ self.b[start:stop].T
            slack = self.slack[some]
            limit = self.limit[some]
            free = np.flatnonzero(np.isinf(limit))
            if len(free) and stop - start > self.best:
                kth = np.partition(near[free], stop - start - self.best, axis=1)[:, stop - start - self.best]
                limit[free] = np.sqrt(np.maximum(self.square[some[free]] - 2.0 * kth, 0) + slack[free])
            least = (self.square[some] - (limit + 2 * 10.0**-DECIMALS) ** 2) / 2 - slack
            hits = np.flatnonzero(near >= least.astype(near.dtype)[:, None])
            for s in range(0, len(hits), _PAIRS_AT_ONCE):
                row, col = np.divmod(hits[s : s + _PAIRS_AT_ONCE], stop - start)
                self._add(some[row], col + start)

    def _add(self, q: np.ndarray, b: np.ndarray) -> None:
        diff = self.query[q] - self.base[b]
        exact = np.round(np.sqrt((diff * diff).sum(1)), DECIMALS)
        close = exact <= self.limit[q]
        self.held.append((q[close], b[close], exact[close]))
        self.new += int(close.sum())
        if self.new > max(_PAIRS_AT_ONCE, len(self.query) * self.best):
            self.pairs()

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, point and distance of the best so far, in order; the limits become those of the last ones."""
        q, b, exact = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((self.ids[b], exact, q))
        q, b, exact = q[order], b[order], exact[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        self.held, self.new = [(q[rank < self.best], b[rank < self.best], exact[rank < self.best])], 0
        last = rank == self.best - 1
        self.limit[q[last]] = np.minimum(self.limit[q[last]], exact[last])
        return self.held[0]


def _best_pairs(
    query: np.ndarray, base: np.ndarray, ids: np.ndarray, part: np.ndarray, best: int,
    radius: np.ndarray | None = None, centers: np.ndarray | None = None, reach: np.ndarray | None = None,
):
    """Query, point and distance of the best points of each query, nearest first.

    ``part`` is the cell of each point, in ascending order.  The nearest cell of a query is
    searched first; others only if they can hold something closer.  With ``centers`` only
    cells whose center is within ``reach`` are searched.
    """
    found = _Nearest(query, base, ids, best, radius)
    cells, starts, sizes = np.unique(part, return_index=True, return_counts=True)
    middle = np.add.reduceat(base, starts, axis=0) / sizes[:, None] if centers is None else centers[cells]
    from_middle = np.sqrt(((base - np.repeat(middle, sizes, axis=0)) ** 2).sum(1))
    inner, outer = np.minimum.reduceat(from_middle, starts), np.maximum.reduceat(from_middle, starts)
    step = max(1, _VALUES_AT_ONCE // len(cells))
    for at in range(0, len(query), step):
        rows = np.arange(at, min(at + step, len(query)))
        away = _distances(query[rows], middle)
        low = np.maximum(away - outer, inner - away) - 2 * _reach(query[rows], base)[:, None]
        if reach is not None:
            low[away > reach[rows, None] * (1 + 1e-9)] = np.inf
        nearest = np.where(np.isinf(low), np.inf, away).argmin(axis=1)
        for first in (True, False):
            for c in range(len(cells)):
                for begin in range(starts[c], starts[c] + sizes[c], _RUN):
                    wanted = (nearest == c) == first
                    wanted &= (low[:, c] <= found.limit[rows]) & np.isfinite(low[:, c])
                    if wanted.any():
                        found.look(rows[wanted], begin, min(begin + _RUN, starts[c] + sizes[c]))
            found.pairs()
    return found.pairs()


def _blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``x`` by small boxes, and where each begins: halves across the widest coordinate."""
    order, starts, work = np.arange(len(x)), [], [(0, len(x))]
    while work:
        begin, end = work.pop()
        if end - begin <= _BLOCK:
            starts.append(begin)
            continue
        rows = order[begin:end]
        values = x[rows]
        column = values[:, (values.max(axis=0) - values.min(axis=0)).argmax()]
        half = (end - begin) // 2
        order[begin:end] = rows[np.argpartition(column, half)]
        work += [(begin + half, end), (begin, begin + half)]
    return order, np.array(starts)


def _best_by_blocks(query: np.ndarray, base: np.ndarray, ids: np.ndarray, best: int, radius: np.ndarray | None = None):
    """As ``_best_pairs``, in few dimensions: a small box of queries against the small boxes of points near it."""
    (q_order, q_starts), (order, starts) = _blocks(query), _blocks(base)
    ends = np.append(starts[1:], len(base))
    points = np.ascontiguousarray(base[order].T)
    low, high = (np.stack([f.reduceat(row, starts) for row in points], axis=1) for f in (np.minimum, np.maximum))
    limits = np.full(len(query), np.inf) if radius is None else radius.astype(float)

    def squares(asked: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.concatenate([np.arange(starts[i], ends[i]) for i in boxes])
        out = np.zeros((len(asked), len(at)))
        for values, row in zip(asked.T, points):
            apart = values[:, None] - row[at]
            out += np.multiply(apart, apart, out=apart)
        return out, at

    found = []
    for begin, end in zip(q_starts, np.append(q_starts[1:], len(query))):
        rows = q_order[begin:end]
        asked, limit = query[rows], limits[rows]
        first, last = asked.min(axis=0), asked.max(axis=0)
        gap = np.maximum(np.maximum(low - last, first - high), 0.0)
        away = (gap * gap).sum(axis=1)
        if np.isinf(limit).any():
            # A bound from the boxes nearest to the middle of the queries.
            middle = np.abs((low + high) / 2 - (first + last) / 2).max(axis=1)
            some = np.argpartition(middle, 3)[:4] if len(starts) > 4 else np.arange(len(starts))
            square, _ = squares(asked, some)
            if square.shape[1] >= best:
                limit = np.minimum(limit, np.sqrt(np.partition(square, best - 1, axis=1)[:, best - 1]))
        bound = limit * (1 + 1e-9) + 2 * 10.0**-DECIMALS
        near = np.flatnonzero(away <= bound.max() ** 2)
        # Some boxes at a time, the nearest first, so that a task holds a bounded matrix.
        near = near[np.argsort(away[near], kind="stable")]
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        step = max(1, _VALUES_AT_ONCE // (_BLOCK * _BLOCK))
        for s in range(0, len(near), step):
            square, at = squares(asked, near[s : s + step])
            q, b = np.divmod(np.flatnonzero(square <= (bound * bound)[:, None]), len(at))
            b = order[at[b]]
            diff = asked[q] - base[b]
            exact = np.round(np.sqrt((diff * diff).sum(1)), DECIMALS)
            close = exact <= limits[rows][q]
            q, b, exact = (np.concatenate(x) for x in zip(held, (q[close], b[close], exact[close])))
            by = np.lexsort((ids[b], exact, q))
            q, b, exact = q[by], b[by], exact[by]
            kept = np.arange(len(q)) - np.searchsorted(q, q) < best
            held = (q[kept], b[kept], exact[kept])
        found.append((rows[held[0]], held[1], held[2]))
    q, b, exact = (np.concatenate(x) for x in zip(*found))
    by = np.argsort(q, kind="stable")
    return q[by], b[by], exact[by]


def _best_of_chunk(k: int, centers: np.ndarray | None = None):
    """Search one chunk of points against one chunk of a cell, whose own cells are named by ``part`` if there are some.

    Vectors with copies give more than ``k`` rows; of queries with a column ``first`` only the first ``k`` come back.
    """

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["qid", "distance", "id", "label"]
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in columns})
        right = right.sort_values("part", kind="stable") if "part" in right else right
        part = right["part"].to_numpy() if "part" in right else np.zeros(len(right), np.int64)
        radius, reach = (left[c].to_numpy() if c in left else None for c in ("radius", "reach"))
        query, base, ids = _matrix(left["qvec"]), _matrix(right["vec"]), right["gid"].to_numpy()
        if centers is None and reach is None and 0 < base.shape[1] <= LOW_DIMENSIONS:
            q, b, exact = _best_by_blocks(query, base, ids, k, radius)
        else:
            q, b, exact = _best_pairs(query, base, ids, part, k, radius, centers, reach)
        copies, labels = right["member_ids"].to_numpy()[b], right["member_labels"].to_numpy()[b]
        times = np.array([len(c) for c in copies], np.int64)
        out = {
            "qid": np.repeat(left["qid"].to_numpy()[q], times),
            "distance": np.repeat(exact, times),
            "id": np.concatenate(list(copies)) if len(q) else np.zeros(0, np.int64),
            "label": np.concatenate(list(labels)) if len(q) else np.zeros(0, np.int32),
        }
        if "first" in left and times.sum() > len(times):
            owner = np.repeat(q, times)
            order = np.lexsort((out["id"], out["distance"], owner))
            order = order[np.arange(len(order)) - np.searchsorted(owner[order], owner[order]) < k]
            out = {c: values[order] for c, values in out.items()}
        return pd.DataFrame(out)

    return search


def _cut_pairs(left: DataFrame, right: DataFrame, cell: str, sizes: DataFrame, tasks: int | None = None):
    """Pairs of chunks of the queries of a cell and of its points, as groups.

    ``sizes`` has cell, q_chunks and b_chunks; ``cell`` names the cell of a query.
    """

    def cut(frame: DataFrame, on: str, key: str, mine: str, other: str) -> DataFrame:
        out = (
            frame.join(sizes, frame[on] == sizes["cell"]).drop(sizes["cell"])
            .withColumn("_own", F.pmod(F.xxhash64(key), F.col(mine)).cast("int"))
            .withColumn("_spread", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("q_chunks", "b_chunks")
        )
        mine_first = [on, "_own", "_spread"] if on == cell else [on, "_spread", "_own"]
        return (out.repartition(tasks, *mine_first) if tasks else out).groupBy(*mine_first)

    return cut(left, cell, "qid", "q_chunks", "b_chunks").cogroup(cut(right, "cell", "gid", "b_chunks", "q_chunks"))


def _chunked(spark, chunk_rows: int, n_query: dict, n_base: dict) -> tuple[DataFrame, int]:
    """Numbers of chunks of each cell that has queries and points, and the number of their pairs."""
    chunks = [
        (int(c), math.ceil(n / chunk_rows), math.ceil(int(n_base[c]) / chunk_rows))
        for c, n in n_query.items()
        if n_base.get(c)
    ]
    return F.broadcast(small_frame(spark, chunks, "cell int, q_chunks int, b_chunks int")), sum(q * b for _, q, b in chunks)


def _search(
    queries: DataFrame, base: DataFrame, k: int, chunk_rows: int, n_query: dict, n_base: dict
) -> DataFrame:
    """Best candidates of every (point, cell) pair: qid, distance, id, label.

    Both sides are cut into chunks of about ``chunk_rows`` by a hash, and each
    pair of chunks of a cell is one group.  ``n_query`` and ``n_base`` are the
    numbers of points per cell.  ``radius`` of a query, if it has one, bounds its
    distances; ``part`` of a point is its place within the cell.
    """
    sizes, pairs = _chunked(base.sparkSession, chunk_rows, n_query, n_base)
    return _search_chunks(queries, base, k, sizes, min(max(pairs, 1), MAX_TASKS))


def _search_chunks(queries: DataFrame, base: DataFrame, k: int, sizes: DataFrame, tasks: int | None = None) -> DataFrame:
    """The search with the numbers of chunks given as a table: cell, q_chunks, b_chunks."""
    part = [c for c in base.columns if c == "part"]
    base = base.select("cell", "gid", "vec", "member_ids", "member_labels", *part)
    return _cut_pairs(queries, base, "qcell", sizes, tasks).applyInPandas(
        _best_of_chunk(k), "qid bigint, distance double, id bigint, label int"
    )


def _keep_best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("distance", "id")
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def _merged(df: DataFrame, best: int, row_id: str, vector: str, label: str | None) -> tuple[DataFrame, DataFrame]:
    """Different vectors with their first ``best`` copies, written; and the rows as they are read."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checked = F.when(values.isNull() | bad, F.raise_error(F.lit("missing or non-finite coordinate")))
    rows = df.select(
        F.col(row_id).cast("bigint").alias("id"),
        checked.otherwise(values).alias("vec"),
        (F.col(label) if label else F.lit(0)).cast("int").alias("label"),
    )
    copies = Window.partitionBy("vec").orderBy("id")
    members = (
        rows.withColumn("_r", F.row_number().over(copies))
        .filter(F.col("_r") <= best)
        .groupBy("vec")
        .agg(F.sort_array(F.collect_list(F.struct("id", "label"))).alias("m"))
    )
    groups = materialize(
        members.select(
            F.col("m")[0]["id"].alias("gid"),
            "vec",
            F.col("m")["id"].alias("member_ids"),
            F.col("m")["label"].alias("member_labels"),
        ),
        "vectors",
    )
    return groups, rows


def nearest_neighbours(
    df: DataFrame,
    k: int,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str | None = None,
    chunk_rows: int = 4_096,
) -> DataFrame:
    """row_id, neighbours: the k nearest other rows, nearest first.

    ``neighbours`` holds (distance, id, label).  ``row_id`` is an integer key.
    A task holds ``chunk_rows`` points of a side, more of a large table (``_task_rows``).
    A row with a missing or non-finite coordinate is an error.
    """
    best = k + 1  # the row itself is one of the copies of its vector
    groups, rows = _merged(df, best, row_id, vector, label)
    shape = groups.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.min(F.size("vec")).alias("d0")
    ).first()
    if not shape["n"]:
        return rows.select(
            F.col("id").alias(row_id),
            F.array().cast("array<struct<distance:double,id:bigint,label:int>>").alias("neighbours"),
        )
    if shape["d"] != shape["d0"]:
        raise ValueError("vectors differ in length")

    def at_home(placed: DataFrame) -> DataFrame:
        return placed.select(
            F.col("gid").alias("qid"), F.col("vec").alias("qvec"), F.col("cell").alias("qcell")
        )

    if shape["n"] <= chunk_rows:
        # One chunk holds all vectors: a single cell, nothing to rule out.
        size = {0: shape["n"]}
        single = groups.withColumn("cell", F.lit(0))
        merged = _keep_best(_search(at_home(single), single, best, chunk_rows, size, size), best)
    elif 0 < shape["d"] <= LOW_DIMENSIONS:
        most = _task_rows(shape["n"], shape["d"], chunk_rows)
        boxes = _Boxes(*_box_sample(groups, shape["n"], shape["d"], most))
        grouped = _boxed(groups, boxes)
        sizes = {r["cell"]: r["count"] for r in grouped.groupBy("cell").count().collect()}
        # One task searches a box, unless it is far larger than asked for: its best are those of the box.
        held = max(most, *sizes.values())
        asked = at_home(grouped).withColumn("first", F.lit(True))
        home = _search(asked, grouped, best, held if held <= 2 * most else most, sizes, sizes)
        own = materialize(home if held <= 2 * most else _keep_best(home, best), "own")
        probes = _box_probes(grouped, own, boxes, best)
        visits = {r["qcell"]: r["count"] for r in probes.groupBy("qcell").count().collect()}
        away = _search(probes.withColumn("first", F.lit(True)), grouped, best, most, visits, sizes)
        merged = own.unionByName(away)  # a few per box reached, cut to the best by ``_per_row``
    else:
        placed, pivots, cells = _place(groups, shape["n"], max(shape["d"], 1))
        # Points travel to groups of cells that lie together; the task rules out cells.
        most = _task_rows(shape["n"], max(shape["d"], 1), chunk_rows)
        held = np.array([cells.get(c, (0.0, 0.0, 0))[2] for c in range(len(pivots))])
        group = _grouped(pivots, held, most)
        sizes = {int(g): int(n) for g, n in enumerate(np.bincount(group, held)) if n}
        of_cell = F.broadcast(small_frame(df.sparkSession, [(c, int(g)) for c, g in enumerate(group)], "part int, cell int"))
        grouped = placed.withColumnRenamed("cell", "part").join(of_cell, "part")
        home = _search(at_home(grouped), grouped, best, most, sizes, sizes)
        own = materialize(_keep_best(home, best), "own")
        probes = _probes(placed, own, pivots, cells, best, group)
        visits = {r["qcell"]: r["count"] for r in probes.groupBy("qcell").count().collect()}
        away = _search(probes, grouped, best, most, visits, sizes)
        merged = _keep_best(own.unionByName(away), best)
    return _per_row(merged, groups, rows, shape["n"], k, row_id)


def _per_row(merged: DataFrame, groups: DataFrame, rows: DataFrame, n: int, k: int, row_id: str) -> DataFrame:
    """Candidates of each different vector as the neighbours of every row that has it."""
    found = F.sort_array(F.collect_list(F.struct("distance", "id", "label")))
    lists = merged.groupBy("qid").agg(F.slice(found, 1, k + 1).alias("near"))
    if rows.count() == n:
        out = lists.withColumnRenamed("qid", "id")
    else:
        owner = rows.select("id", "vec").join(groups.select("vec", "gid"), "vec").select("id", "gid")
        out = owner.join(lists, owner["gid"] == lists["qid"])
    others = F.filter("near", lambda s: s["id"] != F.col("id"))
    return out.select(F.col("id").alias(row_id), F.slice(others, 1, k).alias("neighbours"))


class _Boxes:
    """A full binary tree of cuts, each of one coordinate at a value; its leaves are boxes that fill the space."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, inner = depth, 2**depth - 1
        self.axis, self.cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        d = sample.shape[1]
        held, low, high = [sample], [np.full(d, -np.inf)], [np.full(d, np.inf)]
        for node in range(inner):
            x = held[node]
            if len(x):
                axis = (x.max(axis=0) - x.min(axis=0)).argmax()
                values = np.sort(x[:, axis])
                # Values up to the cut go left; something is to be left for the right.
                below = values[values < values[-1]]
                if len(below):
                    self.axis[node], self.cut[node] = axis, min(values[(len(values) - 1) // 2], below[-1])
            left = x[:, self.axis[node]] <= self.cut[node]
            held += [x[left], x[~left]]
            end, begin = high[node].copy(), low[node].copy()
            end[self.axis[node]] = begin[self.axis[node]] = self.cut[node]
            low += [low[node], begin]
            high += [end, high[node]]
            held[node] = None
        self.low, self.high = np.array(low[inner:]), np.array(high[inner:])

    def box(self, x: np.ndarray) -> np.ndarray:
        """Box of each row of ``x``."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.axis[node]] > self.cut[node])
        return node - len(self.cut)

    def reached(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``x`` and boxes that hold something within the ``radius`` of the row, by row."""
        reach = radius * (1 + 1e-9) + 2 * 10.0**-DECIMALS
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            value, cut = x[row, self.axis[node]], self.cut[node]
            left, right = value - reach[row] <= cut, value + reach[row] > cut
            row = np.concatenate([row[left], row[right]])
            node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
        box = node - len(self.cut)
        gap = np.maximum(np.maximum(self.low[box] - x[row], x[row] - self.high[box]), 0.0)
        near = (gap * gap).sum(axis=1) <= reach[row] ** 2
        order = np.argsort(row[near], kind="stable")
        return row[near][order], box[near][order]


def _box_sample(groups: DataFrame, n: int, d: int, most: int) -> tuple[np.ndarray, int]:
    """Vectors to cut the space by, a choice by a digest, and the depth that leaves about ``most`` in a box."""
    depth = math.ceil(math.log2(max(n / most, 1)))
    wanted = min(_BOX_SAMPLE * 2**depth, MAX_PIVOT_VALUES // d)
    chosen = groups.filter(F.pmod(F.xxhash64("gid"), F.lit(n)) < wanted).select("vec").toPandas()
    return (_matrix(chosen["vec"]) if len(chosen) else np.empty((0, d))), depth


def _boxed(groups: DataFrame, boxes: _Boxes) -> DataFrame:
    """The vectors with the box of each as ``cell``, written."""

    @F.pandas_udf("int")
    def box(vec: pd.Series) -> pd.Series:
        return pd.Series(boxes.box(_matrix(vec)) if len(vec) else [], dtype="int32")

    return materialize(groups.withColumn("cell", box("vec")), "boxes")


def _place(groups: DataFrame, n: int, d: int):
    """Cell of every vector: its nearest pivot.  Pivots are a hashed choice of vectors."""
    n_pivots = max(1, min(math.isqrt(n), MAX_PIVOTS, MAX_PIVOT_VALUES // d))
    chosen = groups.orderBy(F.md5(F.col("gid").cast("string").cast("binary")), "gid").limit(n_pivots)
    pivots = np.array([r["vec"] for r in chosen.select("vec").collect()], dtype=float)

    @F.pandas_udf("cell int, away double")
    def nearest(vec: pd.Series) -> pd.DataFrame:
        cell, away = _nearest_pivot(_matrix(vec), pivots)
        return pd.DataFrame({"cell": cell.astype("int32"), "away": away})

    placed = materialize(
        groups.withColumn("_at", nearest("vec")).select("*", "_at.cell", "_at.away").drop("_at"), "cells"
    )
    stats = placed.groupBy("cell").agg(
        F.min("away").alias("inner"), F.max("away").alias("outer"), F.count(F.lit(1)).alias("n")
    )
    return placed, pivots, {r["cell"]: (r["inner"], r["outer"], r["n"]) for r in stats.collect()}


def _lower_bound(query: np.ndarray, mine: np.ndarray, pivots: np.ndarray, names: np.ndarray, inner: np.ndarray, outer: np.ndarray):
    """Least distance of each query, of cell ``mine``, to the points of the cells ``names``."""
    centers = pivots[names]
    away, between = _distances(query, centers), _distances(pivots[mine], centers)
    to_mine = np.sqrt(((query - pivots[mine]) ** 2).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (away**2 - to_mine[:, None] ** 2) / (2.0 * between)
    bound = np.maximum(away - outer, inner - away)
    return np.maximum(bound, np.where(np.isfinite(plane), plane, 0.0)) - 2 * _reach(query, centers)[:, None]


def _groups_of(near: np.ndarray, group: np.ndarray) -> list[np.ndarray]:
    """For each row of ``near``, a flag per cell, the groups that have a flagged cell."""
    order = np.argsort(group, kind="stable")
    names, starts = np.unique(group[order], return_index=True)
    some = np.logical_or.reduceat(near[:, order], starts, axis=1)
    return [names[row].astype("int32") for row in some]


def _probes(placed: DataFrame, own: DataFrame, pivots: np.ndarray, cells: dict, best: int, group: np.ndarray) -> DataFrame:
    """(qid, qvec, qcell, radius) for the groups of cells, not the own one, that may hold one of the nearest rows."""
    names = np.array(sorted(cells))
    inner = np.array([cells[c][0] for c in names])
    outer = np.array([cells[c][1] for c in names])

    @F.pandas_udf("array<int>")
    def visit(vec: pd.Series, cell: pd.Series, radius: pd.Series) -> pd.Series:
        query, mine, limit = _matrix(vec), cell.to_numpy(), radius.to_numpy(dtype=float)
        out, step = [], max(1, _VALUES_AT_ONCE // len(names))
        for at in range(0, len(query), step):
            e = slice(at, at + step)
            near = _lower_bound(query[e], mine[e], pivots, names, inner, outer) <= limit[e, None]
            out += _groups_of(near & (group[names][None, :] != group[mine[e]][:, None]), group[names])
        return pd.Series(out)

    return _visits(placed, own, best, visit)


def _box_probes(placed: DataFrame, own: DataFrame, boxes: _Boxes, best: int) -> DataFrame:
    """(qid, qvec, qcell, radius) for the boxes, not the own one, that may hold one of the nearest rows."""

    @F.pandas_udf("array<int>")
    def visit(vec: pd.Series, cell: pd.Series, radius: pd.Series) -> pd.Series:
        query, mine, limit = _matrix(vec), cell.to_numpy(), radius.to_numpy(dtype=float)
        out, step = [], max(1, _VALUES_AT_ONCE // len(boxes.low))
        for at in range(0, len(query), step):
            e = slice(at, at + step)
            row, box = boxes.reached(query[e], limit[e])
            other = box != mine[e][row]
            cuts = np.searchsorted(row[other], np.arange(1, len(query[e])))
            out += np.split(box[other].astype("int32"), cuts)
        return pd.Series(out)

    return _visits(placed, own, best, visit)


def _visits(placed: DataFrame, own: DataFrame, best: int, visit) -> DataFrame:
    """(qid, qvec, qcell, radius) for each group that ``visit`` names for a vector, its cell and its radius."""
    radius = own.groupBy("qid").agg(
        F.when(F.count(F.lit(1)) >= best, F.max("distance")).otherwise(F.lit(float("inf"))).alias("radius")
    )
    reached = placed.select(F.col("gid").alias("qid"), F.col("vec").alias("qvec"), "cell").join(radius, "qid")
    visits = reached.select("qid", "qvec", "radius", visit("qvec", "cell", "radius").alias("to"))
    # Read twice, to size the chunks and to search; written before the groups multiply the vectors.
    visits = materialize(visits.filter(F.size("to") > 0), "visits")
    return visits.select("qid", "qvec", "radius", F.explode("to").alias("qcell"))


def neighbour_rows(near: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One row per neighbour: row_id, rank (from 1), neighbour_id, distance."""
    return near.select(row_id, F.posexplode("neighbours").alias("_p", "_s")).select(
        row_id,
        (F.col("_p") + 1).alias("rank"),
        F.col("_s.id").alias("neighbour_id"),
        F.col("_s.distance").alias("distance"),
    )


def neighbour_recall(found: DataFrame, true: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(n, recall): rows of ``true``, and the share of its neighbours that ``found`` has; both as of ``neighbour_rows``."""
    keys = [row_id, "neighbour_id"]
    hits = true.join(found.select(*keys, F.lit(1).alias("hit")), keys, "left")
    return hits.agg(F.countDistinct(row_id).alias("n"), (F.count("hit") / F.count(row_id)).alias("recall"))


# Vectors whose true neighbours are searched to plan the hashing; the most tables; what one more copy
# of a vector and one more group of a search cost, in compared pairs.
PLAN_ROWS, MAX_TABLES, COPY_PAIRS, GROUP_PAIRS = 256, 256, 300, 300_000
# How many times dearer copies are where one task does not hold all vectors, so that they go over disk and network.
FAR_COPY = 10


def _planes(seed: int, d: int, tables: int, bits: int) -> np.ndarray:
    """Planes table by table; more tables begin with the same ones."""
    return np.random.default_rng(seed).normal(size=(tables * bits, d)).T


def _bucket_numbers(x: np.ndarray, planes: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Bucket of each row of ``x``, which is centered, in each table."""
    sides = (x @ planes >= 0).reshape(len(x), tables, bits)
    return (sides * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def _work(tables: int, size: float, chunk_rows: int, dearer: int = 1) -> float:
    """Work per vector in buckets of about ``size``, in compared pairs."""
    chunks = math.ceil(size / chunk_rows)
    return tables * (size + chunks * COPY_PAIRS * dearer + chunks**2 / size * GROUP_PAIRS)


def _plan(groups: DataFrame, n: int, d: int, k: int, center: np.ndarray, most_bits: int, least: float, seed: int, chunk_rows: int):
    """(tables, bits) with the least work whose recall, measured on a sample, is ``least`` with two standard errors to spare.

    The true neighbours of some vectors, a choice by a digest, are searched among
    all.  No bits are one bucket of everything, so some plan always fits.
    """
    if not most_bits or not k:
        return 1, 0
    most = max(16, min(PLAN_ROWS, MAX_PIVOT_VALUES // (d * (k + 1))))
    drawn = groups.orderBy(F.md5(F.col("gid").cast("string").cast("binary")), "gid").limit(most)
    drawn = materialize(drawn.select(F.col("gid").alias("qid"), F.col("vec").alias("qvec"), F.lit(0).alias("qcell")), "drawn")
    single = groups.select(
        "gid", "vec", F.array("gid").alias("member_ids"), F.array(F.lit(0)).alias("member_labels"), F.lit(0).alias("cell")
    )
    true = _keep_best(_search(drawn, single, k + 1, chunk_rows, {0: most}, {0: n}), k + 1).filter("qid <> id")
    pairs = true.join(drawn, "qid").join(groups.select(F.col("gid").alias("id"), "vec"), "id").select("qid", "qvec", "vec")
    rows = pairs.orderBy("qid").collect()
    asked, near = (np.array([r[c] for r in rows], dtype=float) - center for c in ("qvec", "vec"))
    owner = np.unique([r["qid"] for r in rows], return_inverse=True)[1]
    count = np.bincount(owner)
    spread = asked[np.flatnonzero(np.diff(owner, prepend=-1))]
    dearer = FAR_COPY if n > chunk_rows else 1
    best = (_work(1, n, chunk_rows, dearer), 1, 0)
    for bits in range(1, most_bits + 1):
        planes = _planes(seed, d, MAX_TABLES, bits)
        same = _bucket_numbers(asked, planes, MAX_TABLES, bits) == _bucket_numbers(near, planes, MAX_TABLES, bits)
        found = np.logical_or.accumulate(same, axis=1)
        share = np.stack([np.bincount(owner, column) for column in found.T], axis=1) / count[:, None]
        sure = share.mean(axis=0) - 2 * np.sqrt((share.var(axis=0) + 1 / len(count)) / len(count))
        enough = np.flatnonzero(sure >= least)
        if not len(enough):
            continue
        tables = int(enough[0]) + 1
        held = _bucket_numbers(spread, planes, MAX_TABLES, bits)[:, :tables]
        others = [(np.bincount(np.unique(c, return_inverse=True)[1]) ** 2).sum() - len(c) for c in held.T]
        size = max(np.mean(others) / max(len(held) * (len(held) - 1), 1), 0.5**bits) * n
        best = min(best, (_work(tables, max(size, 1.0), chunk_rows, dearer), tables, bits))
    return best[1:]


def hashed_neighbours(
    df: DataFrame,
    k: int,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str | None = None,
    tables: int | None = None,
    bucket_rows: int = 64,
    seed: int = 42,
    chunk_rows: int = 4_096,
    recall: float = 0.9,
) -> DataFrame:
    """Like ``nearest_neighbours``, but only among rows that share a hash bucket; for large n.

    Each of ``tables`` tables deals the vectors to buckets by the sides of random
    hyperplanes through their mean, as many planes as make buckets of about
    ``bucket_rows``.  Planes are drawn from ``seed``, so buckets do not depend on
    partitions.  Inside a bucket the ranking is exact; buckets of any size are cut
    into chunks (``_task_rows``).  A neighbour is missed if it shares no bucket, and the more often the
    smaller the buckets are.  Without ``tables``, their number and that of the planes,
    with ``bucket_rows`` as the smallest bucket, are those of the least work that finds
    ``recall`` of the true neighbours of a sample, searched among all rows; where hashing
    saves nothing, all pairs are compared.  With ``tables`` given nothing is measured:
    see ``neighbour_recall``.  A row may have fewer than k neighbours.
    """
    groups, rows = _merged(df, k + 1, row_id, vector, label)
    shape = groups.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.min(F.size("vec")).alias("d0")).first()
    if not shape["n"]:
        return nearest_neighbours(df, k, row_id, vector, label)
    if shape["d"] != shape["d0"]:
        raise ValueError("vectors differ in length")
    bits = max(0, round(math.log2(max(shape["n"] / bucket_rows, 1))))
    most = _task_rows(shape["n"], shape["d"], chunk_rows)
    center = groups.select(Summarizer.mean(array_to_vector("vec")).alias("m")).first()["m"].toArray()
    if tables is None:
        tables, bits = _plan(groups, shape["n"], shape["d"], k, center, bits, recall, seed, most)
    planes = _planes(seed, shape["d"], tables, bits)

    @F.pandas_udf("array<bigint>")
    def buckets(vec: pd.Series) -> pd.Series:
        return pd.Series(list(_bucket_numbers(_matrix(vec) - center, planes, tables, bits) * tables + np.arange(tables)))

    placed = materialize(groups.withColumn("cells", buckets("vec")), "buckets").withColumn("cell", F.explode("cells")).drop("cells")
    chunks = F.ceil(F.count(F.lit(1)) / most).cast("int")
    sizes = placed.groupBy("cell").agg(chunks.alias("q_chunks"), chunks.alias("b_chunks"))
    queries = placed.select(F.col("gid").alias("qid"), F.col("vec").alias("qvec"), F.col("cell").alias("qcell"))
    pairs = math.ceil(shape["n"] / most) ** 2 * tables  # at least, if no bucket is larger than the others
    found = _search_chunks(queries, placed, k + 1, sizes, min(pairs, MAX_TASKS) if pairs > tables else None)
    found = found.dropDuplicates(["qid", "id"])
    return _per_row(_keep_best(found, k + 1), groups, rows, shape["n"], k, row_id)
