"""Collects the queries by name, each with its checking SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Round doubles to 6 places: the named columns, or every double column."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: F.round(n, 6) for n in names})
