"""Fit / transform stages on scalar columns, for use in ``pyspark.ml.Pipeline``.

``fit`` reads the training rows; ``transform`` is one projection without a
shuffle.  What a stage learned is kept in a JSON parameter, so pipelines with
these stages are saved and loaded like any other.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.functions.scalar import clipped_log, null_if_nan
from panelwise.operators import columns as cols
from panelwise.operators.quantiles import approximate_quantiles, exact_quantiles
from panelwise.session import small_frame


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns to work on", TypeConverters.toListString)

    def _names(self) -> list[str]:
        return self.getOrDefault(self.columns)


class _Stage(_Columns, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, columns: Sequence[str] = (), **extra):
        super().__init__()
        self._set(columns=list(columns), **extra)


class _Learned(Model, _Stage):
    """Model whose fitted values are a JSON document."""

    learned = Param(Params._dummy(), "learned", "fitted values", TypeConverters.toString)

    @classmethod
    def of(cls, columns: Sequence[str], values, **extra):
        return cls(columns, learned=json.dumps(values), **extra)

    def values(self):
        return json.loads(self.getOrDefault(self.learned))


class _Affine(_Learned):
    """x -> (x - center) / width, for stored (center, width) per column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for name, (center, width) in self.values().items():
            if center is None:
                out[name] = F.lit(None).cast("double")
            else:
                out[name] = (F.col(name) - F.lit(center)) / F.lit(width)
        return df.withColumns(out)


class StandardScaleModel(_Affine):
    pass


class StandardScale(Estimator, _Stage):
    """(x - mean) / population deviation; a constant column is only centred."""

    def _fit(self, df: DataFrame) -> StandardScaleModel:
        stats = standard_stats_values(df, self._names())
        fitted = {c: (mean, std or 1.0) for c, (mean, std) in stats.items()}
        return StandardScaleModel.of(self._names(), fitted)


class RobustScaleModel(_Affine):
    pass


class RobustScale(Estimator, _Stage):
    """(x - median) / (q75 - q25); a column with zero spread is only centred.

    ``exact`` off uses one-pass approximate quantiles.
    """

    exact = Param(Params._dummy(), "exact", "exact quantiles", TypeConverters.toBoolean)

    def __init__(self, columns: Sequence[str] = (), exact: bool = True):
        super().__init__(columns, exact=exact)

    def _fit(self, df: DataFrame) -> RobustScaleModel:
        quantiles = robust_stats_values(df, self._names(), self.getOrDefault(self.exact))
        fitted = {
            c: (mid, None if mid is None else ((high - low) or 1.0))
            for c, (low, mid, high) in quantiles.items()
        }
        return RobustScaleModel.of(self._names(), fitted)


def _known(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN being as missing as NULL."""
    return df.select(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in names])


def standard_stats_values(df: DataFrame, names: Sequence[str]) -> dict[str, tuple]:
    row = _known(df, names).agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(names)}


def robust_stats_values(df: DataFrame, names: Sequence[str], exact: bool = True) -> dict[str, list]:
    # Quartiles of the robust scale.
    quartiles = (0.25, 0.5, 0.75)
    find = exact_quantiles if exact else approximate_quantiles
    return find(_known(df, names), names, quartiles)


def standard_stats(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """column_name, mean, std (population); one aggregate."""
    counted = _known(df, names).agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))


def robust_stats(df: DataFrame, names: Sequence[str], exact: bool = True) -> DataFrame:
    """column_name, q25, median, q75."""
    found = robust_stats_values(df, names, exact)
    return small_frame(
        df.sparkSession, [(c, *found[c]) for c in names], "column_name string, q25 double, median double, q75 double"
    )


class MeanImputeModel(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = {c: v for c, v in self.values().items() if v is not None}
        return df.withColumns({c: _filled(df, c, F.lit(v)) for c, v in fills.items()})


def _filled(df: DataFrame, name: str, value: Column) -> Column:
    return F.when(cols.is_missing(df, name), value).otherwise(F.col(name).cast("double"))


class MeanImpute(Estimator, _Stage):
    """Fill missing values with the training mean."""

    def _fit(self, df: DataFrame) -> MeanImputeModel:
        names = self._names()
        row = df.agg(*[F.avg(F.when(~cols.is_missing(df, c), F.col(c))).alias(c) for c in names]).first()
        return MeanImputeModel.of(names, row.asDict())


class OneHotModel(_Learned):
    def _transform(self, df: DataFrame) -> DataFrame:
        made = {}
        for name, values in self.values().items():
            for value in values:
                hit = F.col(name).cast("string") == F.lit(value)
                made[f"{name}_{value}"] = F.coalesce(hit, F.lit(False)).cast("int")
        return df.drop(*made).withColumns(made).drop(*self.values())


class OneHot(Estimator, _Stage):
    """One 0/1 column per training value, named ``column_value``; the source is dropped.

    A missing value gives zeros everywhere.  A column with more than
    ``maxValues`` values is refused, since each becomes a column.
    """

    maxValues = Param(Params._dummy(), "maxValues", "values of a column at most", TypeConverters.toInt)

    def __init__(self, columns: Sequence[str] = (), maxValues: int = 10_000):
        super().__init__(columns, maxValues=maxValues)

    def _fit(self, df: DataFrame) -> OneHotModel:
        found = {}
        most = self.getOrDefault(self.maxValues)
        for name in self._names():
            distinct = (
                df.filter(~cols.is_missing(df, name))
                .select(F.col(name).cast("string").alias("v"))
                .distinct()
                .limit(most + 1)
                .collect()
            )
            if len(distinct) > most:
                raise ValueError(f"too many values to encode: {name}")
            found[name] = sorted(r["v"] for r in distinct)
        return OneHotModel.of(self._names(), found)


class ClippedLog(Transformer, _Stage):
    """ln(max(x, 1e-5) + 1) of the named columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: clipped_log(F.col(c)) for c in self._names()})


class DropColumns(Transformer, _Stage):
    """Drop the named columns; ``strict`` refuses an absent name."""

    strict = Param(Params._dummy(), "strict", "absent name is an error", TypeConverters.toBoolean)

    def __init__(self, columns: Sequence[str] = (), strict: bool = True):
        super().__init__(columns, strict=strict)

    def _transform(self, df: DataFrame) -> DataFrame:
        drop = cols.drop_columns if self.getOrDefault(self.strict) else cols.drop_existing_columns
        return drop(df, self._names())


class DropIncompleteRows(Transformer, _Stage):
    """Drop rows with a missing value in the named columns, or in any when none are named."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return cols.drop_incomplete_rows(df, self._names() or None)
