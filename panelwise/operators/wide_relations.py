"""Correlations of thousands of columns: the matrix of products in blocks of columns.

The matrix is cut into pairs of column blocks.  A pass over the rows adds up as many pairs as
fit into a stated number of bytes per task, and the sums of tasks are added per pair by
Spark; more pairs take more passes.  Correlations are computed where a pair's sums are, so
neither a task nor the driver ever holds the whole matrix, and the result is a table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators.columns import require_columns
from panelwise.operators.relations import PAIR_SCHEMA
from panelwise.session import materialize

#: Columns of a block, bytes of sums that a task holds.
BLOCK, TASK_BYTES = 256, 64 << 20
#: Rows that are turned into a matrix at a time; with all columns they are the rest of a task's memory.
ROWS_AT_ONCE = 2_048
_KINDS = 6  # n, sums of x and y, of their squares, and of their product


def _values(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Columns as a matrix; what is not finite is missing."""
    x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], axis=1)
    x[~np.isfinite(x)] = np.nan
    return x


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _means(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """Mean of each column, one row per column from each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(len(names)), np.zeros(len(names))
        for part in _parts(batches):
            x = _values(part, names)
            total += np.nansum(x, axis=0)
            count += np.isfinite(x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names))), pa.array(total), pa.array(count)], names=["c", "t", "n"])

    found = df.mapInArrow(work, "c long, t double, n double").groupBy("c").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(names))
    out[found["c"].to_numpy()] = found["t"].to_numpy() / np.maximum(found["n"].to_numpy(), 1)
    return out


def correlation_pairs_wide(df: DataFrame, features: Sequence[str], block: int = BLOCK, task_bytes: int = TASK_BYTES) -> DataFrame:
    """feature_a, feature_b, corr (absolute Pearson) for every pair in feature order, as ``correlation_pairs``.

    A row counts for a pair when both values are present and finite; a pair with a
    constant feature has no correlation.  A task holds ``task_bytes`` of sums, and
    ``ROWS_AT_ONCE`` rows; the driver gets one mean per column.
    """
    names = list(features)
    require_columns(df, names)
    spark = df.sparkSession
    cuts = [slice(i, min(i + block, len(names))) for i in range(0, len(names), block)]
    pairs = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]
    at_once = max(1, task_bytes // (_KINDS * block * block * 8))
    passes = [pairs[i : i + at_once] for i in range(0, len(pairs), at_once)]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    shift = _means(rows, names) if names else np.zeros(0)
    out = None
    for some in passes:
        part = _pair_rows(_pass(rows, names, cuts, some, shift), names, cuts, shift)
        part = materialize(part, "correlations")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], PAIR_SCHEMA)
    if rows.isEmpty():
        order = spark.createDataFrame(list(enumerate(names)), "i int, name string")
        later = order.select(F.col("i").alias("j"), F.col("name").alias("feature_b"))
        return order.join(later, F.col("i") < F.col("j")).select(F.col("name").alias("feature_a"), "feature_b", F.lit(None).cast("double").alias("corr"))
    return out


def _pass(rows: DataFrame, names: list[str], cuts: list[slice], some: list[tuple[int, int]], shift: np.ndarray) -> DataFrame:
    """(i, j, kind, line, sums): the sums of the given pairs of blocks, a row per matrix row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for part in _parts(batches):
            x = _values(part, names) - shift
            seen = np.isfinite(x)
            x[~seen] = 0.0
            seen = seen.astype(float)
            for i, j in some:
                a, b = cuts[i], cuts[j]
                found = (
                    seen[:, a].T @ seen[:, b], x[:, a].T @ seen[:, b], seen[:, a].T @ x[:, b],
                    (x[:, a] ** 2).T @ seen[:, b], seen[:, a].T @ (x[:, b] ** 2), x[:, a].T @ x[:, b],
                )
                sums[i, j] = [s + f for s, f in zip(sums[i, j], found)] if (i, j) in sums else list(found)
        for (i, j), six in sums.items():
            flat = np.concatenate([m.ravel() for m in six])
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([flat.tobytes()], pa.binary())], names=["i", "j", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, raw in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("sums")):
                flat = np.frombuffer(raw.as_buffer(), float)
                if (i, j) in held:
                    held[i, j] += flat
                else:
                    held[i, j] = flat.copy()
        for (i, j), flat in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([flat.tobytes()], pa.binary())], names=["i", "j", "sums"])

    schema = "i int, j int, sums binary"
    return rows.mapInArrow(work, schema).repartition("i", "j").mapInArrow(added, schema)


def _pair_rows(blocks: DataFrame, names: list[str], cuts: list[slice], shift: np.ndarray) -> DataFrame:
    """The correlations of the pairs of columns that are in the blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("sums")):
                a, b = np.arange(cuts[i].start, cuts[i].stop), np.arange(cuts[j].start, cuts[j].stop)
                n, sx, sy, sxx, syy, sxy = np.frombuffer(raw.as_buffer(), float).reshape(_KINDS, len(a), len(b))
                with np.errstate(divide="ignore", invalid="ignore"):
                    cov, vx, vy = sxy - sx * sy / n, sxx - sx * sx / n, syy - sy * sy / n
                    # What is left of the variance of a constant column is rounding.
                    vx = np.where(vx > n * (1e-12 * np.abs(shift[a])[:, None]) ** 2, vx, np.nan)
                    vy = np.where(vy > n * (1e-12 * np.abs(shift[b])[None, :]) ** 2, vy, np.nan)
                    corr = np.minimum(np.abs(cov / np.sqrt(vx * vy)), 1.0)
                left, right = np.nonzero(a[:, None] < b[None, :])
                value = corr[left, right]
                known = np.isfinite(value)
                columns = [
                    pa.array([names[k] for k in a[left]], pa.string()), pa.array([names[k] for k in b[right]], pa.string()),
                    pa.array(np.where(known, value, 0.0), mask=~known),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["feature_a", "feature_b", "corr"])

    return blocks.mapInArrow(work, PAIR_SCHEMA)


def correlation_prune_wide(df: DataFrame, features: Sequence[str], threshold: float = 0.6, **options) -> tuple[list[str], DataFrame]:
    """As ``correlation_prune``: the kept names, and the remaining pairs as a table; names of dropped columns alone are fetched."""
    pairs = correlation_pairs_wide(df, features, **options)
    dropped = {r[0] for r in pairs.filter(F.col("corr") > threshold).select("feature_b").distinct().collect()}
    kept = [c for c in features if c not in dropped]
    gone = df.sparkSession.createDataFrame([(c,) for c in sorted(dropped)], "gone string")
    left = pairs.join(gone, F.col("feature_a") == F.col("gone"), "left_anti").join(gone, F.col("feature_b") == F.col("gone"), "left_anti")
    return kept, left


def passes_needed(columns: int, block: int = BLOCK, task_bytes: int = TASK_BYTES) -> int:
    """Passes over the rows for so many columns."""
    blocks = math.ceil(columns / block)
    return math.ceil(blocks * (blocks + 1) / 2 / max(1, task_bytes // (_KINDS * block * block * 8)))
