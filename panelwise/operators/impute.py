"""Chained-equation imputation from sums of products per missing pattern.

Every incomplete column is regressed on all others, in rounds, and its missing
values are replaced by the fitted ones.  A linear fit needs only sums of
products, and an imputed value is a linear function of the observed values of
its row.  So rows with the same missing pattern can be replaced by one matrix of
sums of products, and filling a column changes one row and one column of each
matrix.  The data is read three times, whatever the number of rounds: for means,
for the number of patterns and for the sums per pattern.  Where patterns are not far
fewer than rows, the rows are kept instead and filled anew once per round.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.functions.scalar import null_if_nan
from panelwise.operators.stages import _Learned, _Stage
from panelwise.session import materialize

# Sums kept on the driver: beyond this size they stay in a table on the cluster.
MAX_DRIVER_BYTES = 256 << 20
# Sums held by one task before it hands them on.
MAX_TASK_BYTES = 64 << 20


def bayesian_ridge(gram: np.ndarray, target: int, use: np.ndarray) -> np.ndarray:
    """Ridge fit of one column on others with both precisions found by evidence.

    ``gram`` holds sums of products with an intercept in place 0; ``use`` are the
    predictor places.  Returns weights over all places.  Iterates the noise
    precision and the weight precision to a fixed point (MacKay 1992).
    """
    # Hyper-prior, stop rule and rounds of the evidence iteration.
    prior, tolerance, rounds = 1e-6, 1e-3, 300
    n = gram[0, 0]
    mean_x, mean_y = gram[0, use] / n, gram[0, target] / n
    xx = gram[np.ix_(use, use)] - n * np.outer(mean_x, mean_x)
    xy = gram[use, target] - n * mean_x * mean_y
    yy = max(gram[target, target] - n * mean_y**2, 0.0)
    eig, vec = np.linalg.eigh(xx)
    eig = np.clip(eig, 0.0, None)
    rotated = vec.T @ xy
    noise, weight = 1.0 / (yy / n + np.finfo(float).eps), 1.0

    def solve() -> np.ndarray:
        return vec @ (rotated / (eig + weight / noise))

    old = None
    for _ in range(rounds):
        coef = solve()
        error = max(yy - 2.0 * coef @ xy + coef @ xx @ coef, 0.0)
        well_determined = np.sum(noise * eig / (weight + noise * eig))
        weight = (well_determined + 2 * prior) / (coef @ coef + 2 * prior)
        noise = (n - well_determined + 2 * prior) / (error + 2 * prior)
        if old is not None and np.abs(old - coef).sum() < tolerance:
            break
        old = coef
    coef = solve()
    out = np.zeros(len(gram))
    out[use] = coef
    out[0] = mean_y - mean_x @ coef
    return out


def fill_column(grams: np.ndarray, rows: np.ndarray, place: int, weights: np.ndarray) -> None:
    """Replace column ``place`` by ``weights`` times the others in the given patterns."""
    part = grams[rows]
    line = part @ weights
    square = line @ weights
    grams[rows, place, :] = line
    grams[rows, :, place] = line
    grams[rows, place, place] = square


def _start(grams: np.ndarray, missing: np.ndarray) -> None:
    """Fill with the mean.  Values are shifted by it, so the fill is zero."""
    for place in range(1, grams.shape[1]):
        rows = np.flatnonzero(missing[:, place])
        fill_column(grams, rows, place, np.zeros(grams.shape[1]))


def _decode(patterns: Sequence[str]) -> np.ndarray:
    """Missing mask per pattern, with a False in front for the intercept."""
    return np.array([[False] + [ch == "1" for ch in p] for p in patterns], dtype=bool)


def _pattern_sums(df: DataFrame, names: list[str], shift: np.ndarray) -> DataFrame:
    """(pattern, sums): summed products of the observed, shifted values."""
    size = len(names) + 1
    room = max(1, MAX_TASK_BYTES // (size * size * 8))

    def partial(batches):
        held: dict[str, np.ndarray] = {}

        def out():
            frame = pd.DataFrame(
                {"pattern": list(held), "sums": [m.ravel() for m in held.values()]}
            )
            held.clear()
            return frame

        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - shift
            gone = ~np.isfinite(x)
            full = np.hstack([np.ones((len(x), 1)), np.where(gone, 0.0, x)])
            kinds, which = np.unique(gone, axis=0, return_inverse=True)
            which = which.ravel()
            for i, kind in enumerate(kinds):
                block = full[which == i]
                key = "".join("1" if g else "0" for g in kind)
                if key not in held and len(held) >= room:
                    yield out()
                held[key] = held.get(key, np.zeros((size, size))) + block.T @ block
        if held:
            yield out()

    values = df.select(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in names])
    pieces = values.mapInPandas(partial, "pattern string, sums array<double>")
    return pieces.groupBy("pattern").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")
    )


def _replayed(patterns, sums, size: int, fits) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of some patterns after the given fits."""
    missing = _decode(patterns)
    grams = np.array([np.asarray(s, dtype=float) for s in sums]).reshape(-1, size, size).copy()
    _start(grams, missing)
    for place, weights in fits:
        fill_column(grams, np.flatnonzero(missing[:, place]), place, weights)
    return grams, missing


class _LocalSums:
    """Pattern matrices held on the driver; the size was checked before."""

    def __init__(self, rows, size: int):
        self.grams, self.missing = _replayed([r["pattern"] for r in rows], [r["sums"] for r in rows], size, [])
        # What a filled value is, as a linear function of the observed ones.
        self.maps = np.tile(np.eye(size), (len(rows), 1, 1)) * ~self.missing[:, :, None]

    def observed(self, place: int) -> np.ndarray:
        return self.grams[~self.missing[:, place]].sum(axis=0)

    def fill(self, place: int, weights: np.ndarray) -> None:
        rows = np.flatnonzero(self.missing[:, place])
        fill_column(self.grams, rows, place, weights)
        self.maps[rows, place, :] = np.einsum("j,rjk->rk", weights, self.maps[rows])

    def snapshot(self):
        return self.maps.copy()

    def largest_change(self, before, reach: np.ndarray) -> float:
        """Upper bound of the largest change of a filled value since ``before``."""
        return float((np.abs(self.maps - before) @ reach).max(initial=0.0))


class _SharedSums:
    """Pattern matrices in a table on the cluster; only d x d sums come back."""

    def __init__(self, table: DataFrame, size: int):
        self.table, self.size, self.fits = table, size, []

    def observed(self, place: int) -> np.ndarray:
        size, fits = self.size, list(self.fits)

        def partial(batches):
            for pdf in batches:
                grams, missing = _replayed(pdf["pattern"], pdf["sums"], size, fits)
                yield pd.DataFrame({"s": [grams[~missing[:, place]].sum(axis=0).ravel()]})

        sums = self.table.mapInPandas(partial, "s array<double>")
        total = sums.agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).first()["s"]
        return np.array(total).reshape(size, size)

    def fill(self, place: int, weights: np.ndarray) -> None:
        self.fits.append((place, weights))

    def snapshot(self):
        return len(self.fits)

    def largest_change(self, before: int, reach: np.ndarray) -> float:
        """The same bound as on the driver, as a maximum over the table."""
        size, fits = self.size, list(self.fits)

        def maps_after(missing, upto):
            maps = np.tile(np.eye(size), (len(missing), 1, 1)) * ~missing[:, :, None]
            for place, weights in fits[:upto]:
                rows = np.flatnonzero(missing[:, place])
                maps[rows, place, :] = np.einsum("j,rjk->rk", weights, maps[rows])
            return maps

        def partial(batches):
            for pdf in batches:
                missing = _decode(pdf["pattern"])
                change = np.abs(maps_after(missing, len(fits)) - maps_after(missing, before))
                yield pd.DataFrame({"m": [float((change @ reach).max(initial=0.0))]})

        return self.table.select("pattern").mapInPandas(partial, "m double").agg(F.max("m")).first()[0]


class _RowSums:
    """The rows themselves in a table, filled anew once per round; only d x d sums come back.

    For data with nearly as many missing patterns as rows, where matrices per
    pattern would outgrow the rows.  Fits of the round under way are applied on
    reading, so no round is replayed twice.
    """

    def __init__(self, df: DataFrame, names: list[str], means: np.ndarray):
        self.names, self.fits = names, []
        values = [null_if_nan(F.col(c).cast("double")).alias(c) for c in names]
        gone = F.array(*[F.col(c).isNull() for c in names]).alias("_gone")
        shifted = [F.coalesce(F.col(c) - F.lit(float(m)), F.lit(0.0)).alias(c) for c, m in zip(names, means)]
        self.table = materialize(df.select(*values).select(*shifted, gone), "rows")

    def _filled(self, pdf: pd.DataFrame, fits) -> tuple[np.ndarray, np.ndarray]:
        x = np.hstack([np.ones((len(pdf), 1)), pdf[self.names].to_numpy(dtype=float)])
        gone = np.array(pdf["_gone"].tolist(), dtype=bool).reshape(len(pdf), len(self.names))
        for place, weights in fits:
            rows = np.flatnonzero(gone[:, place - 1])
            x[rows, place] = x[rows] @ weights
        return x, gone

    def observed(self, place: int) -> np.ndarray:
        size, fits, fill = len(self.names) + 1, list(self.fits), self._detached()

        def partial(batches):
            total = np.zeros((size, size))
            for pdf in batches:
                x, gone = fill(pdf, fits)
                seen = x[~gone[:, place - 1]]
                total += seen.T @ seen
            yield pd.DataFrame({"s": [total.ravel()]})

        sums = self.table.mapInPandas(partial, "s array<double>")
        total = sums.agg(vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s")).first()["s"]
        return np.array(total).reshape(size, size)

    def _detached(self):
        """The fill of a batch, without the table, for the tasks."""
        other = object.__new__(_RowSums)
        other.names = self.names
        return other._filled

    def fill(self, place: int, weights: np.ndarray) -> None:
        self.fits.append((place, weights))

    def snapshot(self):
        return None

    def largest_change(self, before, reach: np.ndarray) -> float:
        """The largest change of a filled value in this round; the filled rows become the table."""
        fits, fill, names = list(self.fits), self._detached(), self.names

        def filled(batches):
            for pdf in batches:
                x, _ = fill(pdf, fits)
                out = pd.DataFrame(x[:, 1:], columns=names)
                out["_gone"] = pdf["_gone"].to_numpy()
                out["_moved"] = np.abs(x[:, 1:] - pdf[names].to_numpy(dtype=float)).max(axis=1, initial=0.0)
                yield out

        schema = ", ".join([*(f"`{c}` double" for c in names), "_gone array<boolean>", "_moved double"])
        done = materialize(self.table.mapInPandas(filled, schema), "rows")
        self.table, self.fits = done.drop("_moved"), []
        return float(done.agg(F.max("_moved")).first()[0] or 0.0)


class ChainedImputeModel(_Learned):
    """Replays the fitted rounds on any rows; Arrow batches, no shuffle."""

    @property
    def rounds(self) -> int:
        return self.values()["rounds"]

    @property
    def converged(self) -> bool:
        return self.values()["converged"]

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = self.values()
        names = self._names()
        shift = np.array(fitted["means"])
        steps = [(p, np.array(w)) for p, w in fitted["fits"]]
        if not names:
            return df
        struct = ", ".join(f"`{c}` double" for c in names)

        @F.pandas_udf(struct)
        def filled(frame: pd.DataFrame) -> pd.DataFrame:
            x = frame.to_numpy(dtype=float) - shift
            gone = ~np.isfinite(x)
            full = np.hstack([np.ones((len(x), 1)), np.where(gone, 0.0, x)])
            holes = {p: np.flatnonzero(gone[:, p - 1]) for p, _ in steps}
            for place, weights in steps:
                rows = holes[place]
                full[rows, place] = full[rows] @ weights
            out = np.where(gone, full[:, 1:] + shift, frame.to_numpy(dtype=float))
            return pd.DataFrame(out, columns=names)

        values = F.struct(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in names])
        done = df.withColumn("_filled", filled(values))
        return done.withColumns({c: F.col(f"_filled.`{c}`") for c in names}).drop("_filled")


class ChainedImpute(Estimator, _Stage):
    """Round-robin regression imputation of the incomplete columns.

    Columns are visited by rising number of missing values; complete columns are
    predictors only.  Rounds end after ``maxRounds`` or when no filled value can
    have moved by more than ``tol`` times the largest observed size.  The model
    tells how many ``rounds`` it took and whether it ``converged``.
    """

    maxRounds = Param(Params._dummy(), "maxRounds", "rounds at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative stop threshold", TypeConverters.toFloat)
    maxDriverBytes = Param(
        Params._dummy(), "maxDriverBytes", "size of pattern sums held on the driver", TypeConverters.toInt
    )

    def __init__(
        self, columns: Sequence[str] = (), maxRounds: int = 200, tol: float = 1e-3,
        maxDriverBytes: int = MAX_DRIVER_BYTES,
    ):
        super().__init__(columns, maxRounds=maxRounds, tol=tol, maxDriverBytes=maxDriverBytes)

    def _fit(self, df: DataFrame) -> ChainedImputeModel:
        names = self._names()
        value = {c: null_if_nan(F.col(c).cast("double")) for c in names}
        first = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[
                f(value[c]).alias(f"{t}{i}")
                for i, c in enumerate(names)
                for t, f in (("n", F.count), ("m", F.avg), ("lo", F.min), ("hi", F.max))
            ],
        ).first()
        empty = [c for i, c in enumerate(names) if not first[f"n{i}"]]
        if empty:
            raise ValueError(f"columns without any value: {empty}")
        means = np.array([first[f"m{i}"] for i in range(len(names))])
        low = np.array([first[f"lo{i}"] for i in range(len(names))])
        high = np.array([first[f"hi{i}"] for i in range(len(names))])
        missing = [first["rows"] - first[f"n{i}"] for i in range(len(names))]
        order = [i + 1 for i in sorted(range(len(names)), key=lambda i: missing[i]) if missing[i]]
        fits: list[tuple[int, np.ndarray]] = []
        rounds, converged = 0, True
        if order and len(names) > 1:
            fits, rounds, converged = self._rounds(df, names, means, low, high, order)
        learned = {
            "means": means.tolist(), "fits": [(p, w.tolist()) for p, w in fits], "rounds": rounds, "converged": converged,
        }
        return ChainedImputeModel.of(names, learned)

    def _rounds(self, df, names, means, low, high, order):
        size = len(names) + 1
        pattern = F.array(*[null_if_nan(F.col(c).cast("double")).isNull() for c in names])
        counted = df.select(pattern.cast("string").alias("p")).agg(F.approx_count_distinct("p").alias("p"), F.count(F.lit(1)).alias("n"))
        found = counted.first()
        held = found["p"] * (3 * size * size * 8)
        if held <= self.getOrDefault(self.maxDriverBytes):
            # Counted about; a sixth more is still well within what the driver holds.
            sums = _LocalSums(_pattern_sums(df, names, means).collect(), size)
        elif found["p"] * size * 4 <= found["n"]:
            sums = _SharedSums(materialize(_pattern_sums(df, names, means), "patterns"), size)
        else:
            sums = _RowSums(df, names, means)
        reach = np.concatenate([[1.0], np.maximum(np.abs(low - means), np.abs(high - means))])
        threshold = self.getOrDefault(self.tol) * max(np.abs(low).max(), np.abs(high).max())
        fits, rounds, converged = [], 0, False
        for rounds in range(1, self.getOrDefault(self.maxRounds) + 1):
            before = sums.snapshot()
            for place in order:
                use = np.array([j for j in range(1, size) if j != place])
                weights = bayesian_ridge(sums.observed(place), place, use)
                sums.fill(place, weights)
                fits.append((place, weights))
            if sums.largest_change(before, reach) < threshold:
                converged = True
                break
        return fits, rounds, converged
