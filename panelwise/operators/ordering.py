"""Global order, positions and running sums without a one-task window.

``Window.orderBy`` without partition columns sends all rows to one task.  Here
rows are range-partitioned and sorted, every row keeps its partition number and
its place in the partition, and the result is written once.  Totals per
partition (one row per shuffle partition, so small by construction) then give
the offsets that turn local places into global ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwise.session import broadcast_if_small, materialize

PART = "_part"
SEQ = "_seq"
_SEQ_MASK = (1 << 33) - 1


def order_globally(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort ``df`` and write it with partition number and place in partition.

    The order columns should end in a unique key, so that a value shared by many
    rows can still be cut at a partition border.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = ordered.select(
        "*",
        F.spark_partition_id().alias(PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_SEQ_MASK)).alias(SEQ),
    )
    return materialize(marked, "ordered")


def partition_offsets(ordered: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Sum of each total over all earlier partitions; one row per partition."""
    per_part = ordered.groupBy(PART).agg(*[agg.alias(n) for n, agg in totals.items()])
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        PART, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals]
    )


def with_position(df: DataFrame, *order: Column | str, name: str = "pos") -> DataFrame:
    """Add the 0-based place of every row in the global order."""
    ordered = order_globally(df, *order)
    offsets = partition_offsets(ordered, {"_before": F.count(F.lit(1))})
    placed = ordered.join(F.broadcast(offsets), PART)
    return placed.withColumn(name, F.col("_before") + F.col(SEQ)).drop(
        PART, SEQ, "_before"
    )


def with_group_rank(
    df: DataFrame,
    group: str,
    *order: Column | str,
    name: str = "rank",
    stats: dict[str, Column] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add the 0-based rank inside ``group``; a group may span partitions.

    Rows are placed by (group, order); the rank is the place minus the first
    place of the group.  Meant for few groups, such as classes or strata.
    ``stats`` are further aggregates per group that are attached to the rows,
    after ``derive`` has worked on the table of groups.
    """
    placed = with_position(df, group, *order, name="_pos")
    per_group = placed.groupBy(F.col(group).alias("_group")).agg(
        F.min("_pos").alias("_first"), *[agg.alias(n) for n, agg in (stats or {}).items()]
    )
    if derive is not None:
        per_group = derive(per_group)
    joined = placed.join(broadcast_if_small(per_group), F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(name, F.col("_pos") - F.col("_first")).drop("_pos", "_first", "_group")


def with_running_sums(ordered: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Inclusive running sums over the global order of ``order_globally``.

    ``sums`` maps new column to source column.
    """
    offsets = partition_offsets(
        ordered, {f"_off_{new}": F.sum(src) for new, src in sums.items()}
    )
    local = Window.partitionBy(PART).orderBy(SEQ).rowsBetween(
        Window.unboundedPreceding, 0
    )
    out = ordered.join(F.broadcast(offsets), PART)
    for new, src in sums.items():
        out = out.withColumn(new, F.sum(src).over(local) + F.col(f"_off_{new}"))
    return out.drop(*[f"_off_{new}" for new in sums])


def with_next(ordered: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Value of the following row in the global order, NULL on the last row."""
    heads = ordered.groupBy(PART).agg(
        *[F.min_by(src, SEQ).alias(f"_head_{new}") for new, src in columns.items()]
    )
    following = Window.orderBy(PART)
    heads = heads.select(
        PART,
        *[F.lead(f"_head_{new}").over(following).alias(f"_head_{new}") for new in columns],
    )
    local = Window.partitionBy(PART).orderBy(SEQ)
    out = ordered.join(F.broadcast(heads), PART)
    for new, src in columns.items():
        out = out.withColumn(
            new, F.coalesce(F.lead(src).over(local), F.col(f"_head_{new}"))
        )
    return out.drop(*[f"_head_{new}" for new in columns])
