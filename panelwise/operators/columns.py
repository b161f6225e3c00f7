"""Column-level operators: drop, select, rename, compare schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = missing_features(df, names)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def missing_features(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Names that the frame lacks, in the order asked for."""
    have = set(df.columns)
    return [n for n in names if n not in have]


def same_columns(*frames: DataFrame) -> bool:
    """True when all frames have the same set of column names."""
    return len({frozenset(f.columns) for f in frames}) <= 1


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; an absent name is an error (Spark's own drop is silent)."""
    return require_columns(df, names).drop(*names)


def drop_existing_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop those of the named columns that exist."""
    return df.drop(*names)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating point column."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def drop_sparse_columns(df: DataFrame, max_missing: float, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose missing share is above ``max_missing``; one aggregate."""
    candidates = [c for c in df.columns if c not in set(keep)]
    shares = df.agg(*[F.avg(is_missing(df, c).cast("int")).alias(c) for c in candidates]).first()
    return df.drop(*[c for c in candidates if (shares[c] or 0.0) > max_missing])


def drop_incomplete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any column (NaN counts as missing)."""
    return df.na.drop(how="any", subset=list(subset) if subset is not None else None)


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of every name."""
    unique = [f"c{i}" for i in range(len(df.columns))]
    first: dict[str, str] = {}
    for name, alias in zip(df.columns, unique):
        first.setdefault(name, alias)
    return df.toDF(*unique).select(*[F.col(a).alias(n) for n, a in first.items()])


def normalize_names(df: DataFrame, index_column: str | None = "Unnamed: 0") -> DataFrame:
    """Strip column names and drop a left-over index column."""
    named = df.toDF(*[str(c).strip() for c in df.columns])
    return named.drop(index_column) if index_column in named.columns else named


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def separate_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(features, label) as two projections of the same frame."""
    require_columns(df, [label])
    return df.drop(label), df.select(label)


def require_scalar(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Reject nested feature columns; the schema says it, no row is read."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    bad = [c for c in features if isinstance(df.schema[c].dataType, nested)]
    if bad:
        raise ValueError(f"columns hold nested data: {bad}")
    return df
