"""Entity-level splits, folds and samples that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwise.functions.scalar import hash_key
from panelwise.operators.ordering import with_group_rank
from panelwise.roles import ColumnRoles
from panelwise.session import broadcast_if_small

SPLITS = ("train", "val", "test")

# Blocks (class and fold) that become one expression; with more the folds are joined.
MAX_STARTS = 1_000


def entity_stats(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Per entity: ever positive, number of time points, number of rows."""
    return df.groupBy(F.col(roles.entity).cast("string").alias("entity")).agg(
        F.max(roles.label).alias("label"),
        F.count(roles.time).alias("n_times"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _check_fractions(train: float, val: float) -> None:
    if not 0 < train + val < 1:
        raise ValueError("train + val must be between 0 and 1")


def split_entities(
    df: DataFrame,
    roles: ColumnRoles,
    train: float = 0.7,
    val: float = 0.15,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Assign every entity to train, val or test: (entity, label, n_rows, split).

    Entities are ordered by a seeded digest within their stratum (ever positive
    or not; one stratum when ``stratify`` is off).  The first floor(n * train)
    go to train, the next floor(n * val) to val, the rest to test.
    """
    _check_fractions(train, val)
    stats = entity_stats(df, roles)
    stratum = F.coalesce(F.col("label"), F.lit(0)) if stratify else F.lit(0)
    keyed = stats.withColumns({"_stratum": stratum, "_key": hash_key(F.col("entity"), seed)})
    ranked = with_group_rank(
        keyed, "_stratum", "_key", "entity", name="_rank", stats={"_n": F.count(F.lit(1))}
    )
    n_train = F.floor(F.col("_n") * F.lit(float(train)))
    n_val = F.floor(F.col("_n") * F.lit(float(val)))
    split = (
        F.when(F.col("_rank") < n_train, SPLITS[0])
        .when(F.col("_rank") < n_train + n_val, SPLITS[1])
        .otherwise(SPLITS[2])
    )
    return ranked.select("entity", "label", "n_rows", split.alias("split"))


def split_rows(df: DataFrame, assignment: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Tag every row with the split of its entity (one join for all splits)."""
    names = assignment.select(F.col("entity").alias("_entity"), "split")
    joined = df.join(broadcast_if_small(names), F.col(roles.entity).cast("string") == F.col("_entity"))
    return joined.drop("_entity")


def split_summary(assignment: DataFrame) -> DataFrame:
    """Rows and entities per split, from the entity table alone."""
    return assignment.groupBy("split").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_entities")
    )


def split_positive_rate(assignment: DataFrame) -> DataFrame:
    """Share of entities that are ever positive, per split."""
    return assignment.groupBy("split").agg(F.avg("label").alias("positive_rate"))


def split_overlap(tagged: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Entities that occur in more than one split; empty for a sound split."""
    return (
        tagged.groupBy(F.col(roles.entity).alias("entity"))
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def assert_disjoint(tagged: DataFrame, roles: ColumnRoles) -> DataFrame:
    shared = split_overlap(tagged, roles).limit(1).collect()
    if shared:
        raise ValueError(f"entity in more than one split: {shared[0]['entity']}")
    return tagged


def stratified_folds(df: DataFrame, roles: ColumnRoles, k: int, name: str = "fold") -> DataFrame:
    """Fold number per row: unshuffled, contiguous blocks per class in row order.

    Classes are laid end to end in order of first appearance and positions are
    dealt to folds in turn; that fixes how many rows of each class a fold gets.
    """
    bounds = [f"_b{i}" for i in range(k - 1)]

    def upto(end: Column, fold: int) -> Column:
        """Positions below ``end`` that are dealt to folds 0..fold."""
        full = F.floor(end / F.lit(k))
        return full * (fold + 1) + F.least(end - full * k, F.lit(fold + 1))

    def with_bounds(classes: DataFrame) -> DataFrame:
        """Rows of the class in folds 0..i, for every i but the last."""
        earlier = Window.orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)
        start = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        laid = classes.withColumn("_o", start)
        sizes = [
            (upto(F.col("_o") + F.col("_n"), i) - upto(F.col("_o"), i)).alias(b)
            for i, b in enumerate(bounds)
        ]
        return laid.select("_group", "_first", *sizes)

    # Only the keys are ranked; blocks are contiguous, so their first keys tell a row's fold.
    ranked = with_group_rank(
        df.select(roles.label, roles.row_id), roles.label, roles.row_id, name="_rank",
        stats={"_n": F.count(F.lit(1)), "_lead": F.min(roles.row_id)}, derive=with_bounds,
    )
    fold = sum(((F.col("_rank") >= F.col(b)).cast("int") for b in bounds), F.lit(0))
    keyed = ranked.select(F.col(roles.label).alias("_label"), F.col(roles.row_id).alias("_id"), fold.alias("_fold"))
    first = keyed.groupBy("_label", "_fold").agg(F.min("_id").alias("_from"))
    starts = first.orderBy("_label", "_fold").limit(MAX_STARTS + 1).collect()
    if len(starts) > MAX_STARTS:
        placed = keyed.select("_id", F.col("_fold").alias(name))
        return df.join(placed, F.col(roles.row_id) == F.col("_id")).drop("_id")
    by_class: dict = {}
    for r in starts:
        by_class.setdefault(r["_label"], []).append((r["_fold"], r["_from"]))
    out = F.lit(None).cast("int")
    for value, blocks in by_class.items():
        own = F.lit(blocks[0][0])
        for number, start in blocks[1:]:
            own = F.when(F.col(roles.row_id) >= F.lit(start), F.lit(number)).otherwise(own)
        out = F.when(F.col(roles.label).eqNullSafe(F.lit(value)), own).otherwise(out)
    return df.withColumn(name, out)


def sample_entities(df: DataFrame, roles: ColumnRoles, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` entities with a positive row, without replacement, by seeded order."""
    return (
        df.filter(F.col(roles.label) == 1)
        .select(F.col(roles.entity).cast("string").alias("entity"))
        .distinct()
        .orderBy(hash_key(F.col("entity"), seed), "entity")
        .limit(n)
    )
