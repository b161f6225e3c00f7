"""Profiles that grow with the data: mergeable states per part of the input, kept in a table.

A part is whatever arrives together, such as a day.  Its state per column holds counts, mean
and squared deviations, extremes, a sketch of the distribution and one of the different
values; all of these merge.  A new part is read once, alone; a profile of everything, or
of some parts, is one aggregate over the states and reads no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.operators.columns import require_columns
from panelwise.session import path_exists

#: Size of the distribution's sketch, and what its ranks are off at most, in 99 of 100 cases.
SKETCH_SIZE, RANK_ERROR = 800, 0.006
#: Parts that one call may add or ask for.
MAX_PARTS = 100_000
STATE_SCHEMA = (
    "column_name string, n long, n_missing long, mean double, m2 double, low double, high double, "
    "spread binary, different binary, part string"
)


def part_states(df: DataFrame, columns: Sequence[str], part: Column) -> DataFrame:
    """One row per part and column with the part's state; NaN and infinite values count as missing."""
    names = list(columns)
    require_columns(df, names)
    values = []
    for i, c in enumerate(names):
        x = F.col(f"`{c}`").cast("double")
        values.append(F.when(F.abs(x) < F.lit(float("inf")), x).alias(f"x{i}"))
    rows = df.select(part.cast("string").alias("part"), *values)
    aggregates = []
    for i in range(len(names)):
        x = F.col(f"x{i}")
        aggregates += [
            F.count(x).alias(f"n{i}"), (F.count(F.lit(1)) - F.count(x)).alias(f"g{i}"), F.avg(x).alias(f"m{i}"),
            (F.var_pop(x) * F.count(x)).alias(f"v{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
            F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE)).alias(f"s{i}"), F.hll_sketch_agg(x.cast("string")).alias(f"d{i}"),
        ]
    wide = rows.groupBy("part").agg(*aggregates) if names else rows.select("part").distinct()
    kinds = zip("ngmvlhsd", ("n", "n_missing", "mean", "m2", "low", "high", "spread", "different"))
    kinds = list(kinds)
    entries = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}{i}").alias(n) for k, n in kinds]) for i, c in enumerate(names)]
    return wide.select(F.inline(F.array(*entries)), "part") if names else df.sparkSession.createDataFrame([], STATE_SCHEMA)


def update_states(df: DataFrame, columns: Sequence[str], part: Column, path: str, again: Sequence[str] = ()) -> list[str]:
    """Add the states of the parts that the table at ``path`` does not have, and replace those named in ``again``.

    Returns the parts that were read.  Rows of known parts are filtered out before
    anything is computed, so a table laid out by part is read in its new parts only.
    """
    spark = df.sparkSession
    known: set = set()
    if path_exists(spark, path):
        known = {r[0] for r in read_states(spark, path).select("part").distinct().limit(MAX_PARTS).collect()} - set(again)
    named = df.withColumn("_part", part.cast("string"))
    new = named.filter(F.col("_part").isNotNull() & ~F.col("_part").isin(*known)) if known else named.filter("_part IS NOT NULL")
    states = part_states(new.drop("_part"), columns, part)
    mode = {"partitionOverwriteMode": "dynamic"}
    states.write.mode("overwrite").options(**mode).partitionBy("part").parquet(path)
    if not path_exists(spark, path):
        return []
    now = {r[0] for r in read_states(spark, path).select("part").distinct().limit(MAX_PARTS).collect()}
    return sorted(now - known)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def merged_profile(states: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, n, n_missing, mean, std, low, high, n_different, quantiles) over all parts of ``states``.

    ``n_different`` is an estimate; each of the ``quantiles`` is a value whose rank is within
    ``RANK_ERROR`` of the share.  A column without a value has nulls.
    """
    total = F.sum("n")
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")), total)
    first = states.groupBy("column_name").agg(
        total.alias("n"), F.sum("n_missing").alias("n_missing"), mean.alias("mean"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("different").alias("different"), F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("spread"))).alias("spread"),
    )
    middle = first.select(F.col("column_name").alias("_name"), F.col("mean").alias("_mean"))
    # Deviations are taken about the merged mean, so that large means cost no digits.
    parts = states.join(F.broadcast(middle), F.col("column_name") == F.col("_name"))
    off = F.col("mean") - F.col("_mean")
    squares = parts.groupBy("column_name").agg(F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))
    some = F.col("n") > 0
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    return first.join(squares, "column_name").select(
        "column_name", "n", "n_missing", "mean", F.when(some, F.sqrt(F.col("m2") / F.col("n"))).alias("std"), "low", "high",
        F.when(some, F.hll_sketch_estimate("different")).otherwise(0).alias("n_different"),
        F.when(some, F.kll_sketch_get_quantile_double("spread", wanted)).alias("quantiles"),
    )
