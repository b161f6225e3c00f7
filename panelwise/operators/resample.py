"""Over-sampling by interpolation and cleaning by neighbours."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.functions.scalar import hash_draw, hash_uniform
from panelwise.operators.neighbours import nearest_neighbours
from panelwise.operators.ordering import with_position
from panelwise.session import materialize


def pack(df: DataFrame, features: Sequence[str], row_id: str = "row_id", label: str = "label") -> DataFrame:
    """row_id, label and the features as one array."""
    return df.select(row_id, label, F.array(*[F.col(c).cast("double") for c in features]).alias("vec"))


def unpack(df: DataFrame, features: Sequence[str], vector: str = "vec") -> DataFrame:
    return df.select(
        *[c for c in df.columns if c != vector],
        *[F.col(vector)[i].alias(c) for i, c in enumerate(features)],
    )


def smote_draws(
    df: DataFrame,
    minority: int = 1,
    k: int = 6,
    ratio: float = 1.0,
    seed: int = 42,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str = "label",
    search: Callable[..., DataFrame] = nearest_neighbours,
) -> DataFrame:
    """New rows on the segments from a minority row to one of its k minority neighbours.

    As many as are needed for ``ratio`` minority rows per row of the largest
    other class.  Row, neighbour and position come from a digest of the number
    of the new row, so the result is the same under any partitioning.  Columns:
    row_id (after the largest id), label, base_id, neighbour_id, u, vector.
    ``search`` finds the neighbours; ``hashed_neighbours`` is the one for many
    minority rows, and a row for which it finds fewer than k draws among those.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    n_min = counts.get(minority, 0)
    n_new = int(max((n for v, n in counts.items() if v != minority), default=0) * ratio - n_min)
    if n_new > 0 and n_min <= k:
        raise ValueError(f"{n_min} minority rows are too few for {k} neighbours")
    rare = df.filter(F.col(label) == minority).select(row_id, vector)
    near = search(rare, k, row_id, vector)
    based = rare.join(near, row_id).select(
        F.col(row_id).alias("base_id"), F.col(vector).alias("_base"), F.col("neighbours")["id"].alias("_near")
    )
    # A search may find fewer than k: they are taken in turn, a row without any stays where it is.
    found = F.when(F.size("_near") > 0, F.col("_near")).otherwise(F.array("base_id"))
    turns = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get(found, F.pmod(i, F.size(found))))
    based = based.withColumn("_near", turns)
    ranked = with_position(based, "base_id", name="_rank")
    number = F.col("id")
    draws = df.sparkSession.range(max(n_new, 0)).select(
        number.alias("_j"),
        F.pmod(hash_draw(number, seed, "base"), F.lit(max(n_min, 1))).alias("_rank"),
        F.pmod(hash_draw(number, seed, "neighbour"), F.lit(k)).cast("int").alias("_pick"),
        hash_uniform(number, seed, "u").alias("u"),
    )
    # Both ends are joined on the rare side, so that only numbers of the many new rows move.
    ends = rare.select(F.col(row_id).alias("neighbour_id"), F.col(vector).alias("_end"))
    pairs = ranked.select(
        "_rank", "base_id", "_base", F.posexplode("_near").alias("_pick", "neighbour_id")
    ).join(ends, "neighbour_id")
    last = df.agg(F.max(row_id)).first()[0]
    between = F.zip_with("_base", "_end", lambda a, b: a + F.col("u") * (b - a))
    return draws.join(pairs, ["_rank", "_pick"]).select(
        (F.lit(last) + 1 + F.col("_j")).alias(row_id),
        F.lit(minority).cast(df.schema[label].dataType).alias(label),
        "base_id",
        "neighbour_id",
        "u",
        between.alias(vector),
    )


def smote_oversample(df: DataFrame, **options) -> DataFrame:
    """The given rows and the new ones: row_id, label, vector, synthetic."""
    row_id, vector = options.get("row_id", "row_id"), options.get("vector", "vec")
    label = options.get("label", "label")
    keep = [row_id, label, vector]
    made = smote_draws(df, **options).select(*keep, F.lit(True).alias("synthetic"))
    return df.select(*keep, F.lit(False).alias("synthetic")).unionByName(made)


def enn_clean(
    df: DataFrame,
    clean_labels: Sequence[int],
    k: int = 5,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str = "label",
    search: Callable[..., DataFrame] = nearest_neighbours,
) -> DataFrame:
    """Drop rows of the cleaned classes unless all k neighbours share their label.

    The classes to clean are an explicit argument: after balancing, sizes no
    longer tell which class is rare.
    """
    near = search(df, k, row_id, vector, label)
    agree = near.select(row_id, F.col("neighbours")["label"].alias("_labels"))
    same = F.forall("_labels", lambda x: x == F.col(label))
    keep = ~F.col(label).isin(*clean_labels) | same
    return df.join(agree, row_id).filter(keep).drop("_labels")


def smote_enn(
    df: DataFrame,
    clean_labels: Sequence[int],
    minority: int = 1,
    smote_k: int = 6,
    enn_k: int = 5,
    ratio: float = 1.0,
    seed: int = 42,
    row_id: str = "row_id",
    vector: str = "vec",
    label: str = "label",
) -> DataFrame:
    """Over-sample the minority, then clean by neighbours."""
    names = dict(row_id=row_id, vector=vector, label=label)
    grown = smote_oversample(df, minority=minority, k=smote_k, ratio=ratio, seed=seed, **names)
    return enn_clean(materialize(grown, "grown"), clean_labels, enn_k, **names)
