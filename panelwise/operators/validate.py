"""Rule checks and profiles of a panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.operators.columns import is_missing, require_columns
from panelwise.operators.counts import class_distribution
from panelwise.roles import ColumnRoles
from panelwise.session import small_frame


def duplicate_keys(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """(entity, time) pairs that occur more than once, with their count."""
    keys = [roles.entity, roles.time]
    return (
        df.select(*keys)
        .na.drop()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def validate_panel(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """One row per rule with the number of violations.

    Type and range rules share one aggregate; the duplicate rule adds one
    grouping on the key.
    """
    require_columns(df, [roles.entity, roles.time, roles.label])
    for name in (roles.time, roles.label):
        if not isinstance(df.schema[name].dataType, T.NumericType):
            raise ValueError(f"column must be numeric: {name}")
    time, label = F.col(roles.time), F.col(roles.label)
    ranges = df.agg(
        F.count_if(time < 0).alias("negative_time"),
        F.count_if(label.isNull() | ~label.isin(0, 1)).alias("label_not_binary"),
    )
    long = ranges.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations"))
                    for rule in ("negative_time", "label_not_binary")
                ]
            )
        )
    )
    repeated = duplicate_keys(df, roles).agg(
        F.lit("duplicate_time_points").alias("rule"), F.count(F.lit(1)).alias("violations")
    )
    return long.unionByName(repeated.select("rule", "violations"))


def assert_valid(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Raise ``ValueError`` naming the rules that are violated, else return ``df``."""
    broken = validate_panel(df, roles).filter(F.col("violations") > 0).collect()
    if broken:
        raise ValueError(", ".join(f"{r['rule']}: {r['violations']}" for r in broken))
    return df


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent per column from one aggregate."""
    names = list(columns or df.columns)
    total = F.count(F.lit(1))
    counted = df.agg(
        total.alias("_rows"), *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_m{i}").alias("n_missing"),
            (F.try_divide(F.col(f"_m{i}"), F.col("_rows")) * 100.0).alias("pct_missing"),
        )
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))


def missing_mask(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """0/1 per row and column, 1 where the value is missing."""
    return df.select(key, *[is_missing(df, c).cast("int").alias(c) for c in columns])


def _section(name: str, df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("section"), key.cast("string").alias("key"), value.cast("double").alias("value")
    )


def profile_table(df: DataFrame, label: str | None = None) -> DataFrame:
    """(section, key, value): shape, columns with missing values, class counts.

    Shape and missing counts come from one pass.
    """
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(names)).alias("columns"),
        *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(names)],
    )

    def entry(section: str, key: str, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), F.lit(key).alias("key"), value.cast("double").alias("value")
        )

    entries = [entry("shape", c, F.col(c)) for c in ("rows", "columns")]
    for i, c in enumerate(names):
        entries.append(entry("missing", c, F.col(f"_m{i}")))
        entries.append(entry("missing_pct", c, F.try_divide(F.col(f"_m{i}"), F.col("rows")) * 100.0))
    out = counted.select(F.inline(F.array(*entries))).filter(
        (F.col("section") == "shape") | (F.col("value") > 0)
    )
    if label is not None:
        out = out.unionByName(
            _section("class", class_distribution(df, label), F.col("label"), F.col("n"))
        )
    return out


def value_counts(df: DataFrame, column: str, max_distinct: int = 10) -> DataFrame:
    """Value counts of a column, empty when it has more than ``max_distinct`` values.

    The report is only shown for columns with few values; the number of values
    is found from at most ``max_distinct + 1`` of them.
    """
    counted = df.filter(~is_missing(df, column)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    few = counted.limit(max_distinct + 1).count() <= max_distinct
    return counted if few else counted.limit(0)


def card_stats(
    splits: DataFrame,
    roles: ColumnRoles,
    metrics: Mapping[str, float | None],
    split_column: str = "split",
    train: str = "train",
) -> DataFrame:
    """Model-card statistics as (section, key, value).

    Rows per split, number of columns, label shares of the training split and
    the given metrics at 4 decimals.
    """
    by = splits.groupBy(split_column, F.col(roles.label).alias("_y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = by.groupBy(split_column).agg(F.sum("n").alias("n"))
    out = _section("samples", rows, F.col(split_column), F.col("n"))
    shares = by.filter(F.col(split_column) == train).groupBy("_y").agg(F.sum("n").alias("n"))
    shares = shares.withColumn("t", F.sum("n").over(Window.partitionBy()))
    out = out.unionByName(
        _section("class_share", shares, F.col("_y"), F.col("n") / F.col("t"))
    )
    n_columns = len([c for c in splits.columns if c != split_column])
    fixed = [("features", "columns", float(n_columns))] + [
        ("metric", name, None if value is None else round(float(value), 4))
        for name, value in metrics.items()
    ]
    extra = small_frame(splits.sparkSession, fixed, "section string, key string, value double")
    return out.unionByName(extra)
