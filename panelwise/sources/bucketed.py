"""Panels bucketed by entity and sorted by time, so that work per entity needs no shuffle.

Rows of an entity are in one bucket, buckets of the same number line up between tables, and
each bucket is one sorted file.  Windows, onsets, statistics per entity and joins on the
entity then run bucket by bucket: their plans have no exchange.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.roles import ColumnRoles
from panelwise.session import session_folder

#: Rows of a bucket, about; most buckets of a table.
BUCKET_ROWS, MAX_BUCKETS = 2_000_000, 100_000


def bucket_count(rows: int) -> int:
    return max(1, min(math.ceil(rows / BUCKET_ROWS), MAX_BUCKETS))


def write_bucketed(df: DataFrame, roles: ColumnRoles, name: str | None = None, buckets: int | None = None, path: str | None = None) -> str:
    """Write ``df`` as a table bucketed by entity and sorted by time; returns its name.

    Tables that are to be joined need the same number of ``buckets``.  Rows of an entity
    stay together, so an entity should not have more rows than a task can read.
    """
    spark = df.sparkSession
    buckets = buckets or bucket_count(df.count())
    name = name or f"bucketed_{uuid.uuid4().hex}"
    order = [c for c in (roles.time, roles.row_id) if c in df.columns]
    dealt = df.repartition(buckets, roles.entity)
    writer = dealt.write.mode("overwrite").option("path", path or f"{session_folder(spark)}/{name}").bucketBy(buckets, roles.entity)
    writer.sortBy(roles.entity, *order).saveAsTable(name)
    return name


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def assign_bucketed(df: DataFrame, assignment: DataFrame, roles: ColumnRoles) -> DataFrame:
    """As ``split_rows``, for two tables bucketed alike: each bucket meets its own entities, and nothing moves."""
    names = assignment.select(F.col(roles.entity).alias("_entity"), "split")
    return df.join(names.hint("merge"), F.col(roles.entity) == F.col("_entity")).drop("_entity")


def has_exchange(df: DataFrame) -> bool:
    """Whether the plan of ``df`` shuffles or broadcasts."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()
