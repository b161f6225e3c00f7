"""Neighbours and resampling on the embedding vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.operators import edited, inverted, neighbours, resample
from workload.registry import query, r6
from workload.views import VECTORS_SQL, vectors


def _knn_sql(source: str, k: int, name: str = "knn") -> str:
    """Brute force over all pairs, distances at 6 decimals, ties by id."""
    return f"""{name}_d AS (SELECT a.row_id, b.row_id AS neighbour_id, b.label AS nl,
    round(list_distance(a.vec, b.vec), 6) AS distance FROM {source} a JOIN {source} b ON a.row_id <> b.row_id),
{name} AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbour_id) AS rank
    FROM {name}_d QUALIFY rank <= {k})"""


@query(
    "knn_exact",
    f"""WITH {VECTORS_SQL}, {_knn_sql('vectors', 5)}
SELECT row_id, CAST(rank AS INTEGER) AS rank, neighbour_id, distance FROM knn""",
)
def _knn(spark, sf_dir) -> DataFrame:
    return neighbours.neighbour_rows(neighbours.nearest_neighbours(vectors(spark, sf_dir), 5))


@query(
    "knn_cells",
    f"""WITH {VECTORS_SQL}, {_knn_sql('vectors', 5)}
SELECT row_id, CAST(rank AS INTEGER) AS rank, neighbour_id, distance FROM knn""",
)
def _knn_cells(spark, sf_dir) -> DataFrame:
    """The same rows by the route of large tables: cells around pivots, cut into chunks."""
    return neighbours.neighbour_rows(neighbours.nearest_neighbours(vectors(spark, sf_dir), 5, chunk_rows=64))


@query("knn_hashed")
def _knn_hashed(spark, sf_dir) -> DataFrame:
    return neighbours.neighbour_rows(neighbours.hashed_neighbours(vectors(spark, sf_dir), 5))


@query(
    "knn_hashed_recall",
    "SELECT count(*) AS n, true AS enough FROM embeddings",
)
def _knn_hashed_recall(spark, sf_dir) -> DataFrame:
    """Rows searched, and whether nine in ten of the true neighbours are found."""
    measured = neighbours.neighbour_recall(_knn_hashed(spark, sf_dir), _knn(spark, sf_dir))
    return measured.select("n", (F.col("recall") >= 0.9).alias("enough"))


@query("knn_hashed_recall_share")
def _knn_hashed_recall_share(spark, sf_dir) -> DataFrame:
    """Rows searched, and the share of the true neighbours that are found."""
    return neighbours.neighbour_recall(_knn_hashed(spark, sf_dir), _knn(spark, sf_dir))


@query("knn_inverted")
def _knn_inverted(spark, sf_dir) -> DataFrame:
    return neighbours.neighbour_rows(inverted.inverted_neighbours(vectors(spark, sf_dir), 5))


@query(
    "knn_inverted_all",
    f"""WITH {VECTORS_SQL}, {_knn_sql('vectors', 5)}
SELECT row_id, CAST(rank AS INTEGER) AS rank, neighbour_id, distance FROM knn""",
)
def _knn_inverted_all(spark, sf_dir) -> DataFrame:
    """All cells probed, in several groups: the exact neighbours."""
    near = inverted.inverted_neighbours(vectors(spark, sf_dir), 5, recall=1.0, group_rows=100, chunk_rows=300)
    return neighbours.neighbour_rows(near)


@query("knn_inverted_recall")
def _knn_inverted_recall(spark, sf_dir) -> DataFrame:
    """Rows searched, and the share of the true neighbours that are found."""
    return neighbours.neighbour_recall(_knn_inverted(spark, sf_dir), _knn(spark, sf_dir))


def _draw(purpose: str) -> str:
    return f"CAST('0x' || substr(md5(CAST(j AS VARCHAR) || ':42:{purpose}'), 1, 15) AS BIGINT)"


SMOTE_SQL = f"""{VECTORS_SQL},
rare AS (SELECT * FROM vectors WHERE label = 1), {_knn_sql('rare', 6, 'near')},
ranked AS (SELECT row_id AS base_id, vec, row_number() OVER (ORDER BY row_id) - 1 AS r FROM rare),
sizes AS (SELECT count(*) FILTER (label = 1) AS n_min, count(*) FILTER (label = 0) AS n_maj, max(row_id) AS last FROM vectors),
draws AS (SELECT j, last, {_draw('base')} % n_min AS r, {_draw('neighbour')} % 6 + 1 AS pick,
                 CAST({_draw('u')} AS DOUBLE) / 1152921504606846976.0::DOUBLE AS u
          FROM sizes, range(n_maj - n_min) t(j)),
made AS (SELECT last + 1 + j AS row_id, 1 AS label, b.base_id, n.neighbour_id, u,
                [x[1] + d.u * (x[2] - x[1]) for x in list_zip(b.vec, e.vec)] AS vec
         FROM draws d JOIN ranked b ON b.r = d.r
         JOIN near n ON n.row_id = b.base_id AND n.rank = d.pick
         JOIN rare e ON e.row_id = n.neighbour_id)"""


@query(
    "smote_draws",
    f"WITH {SMOTE_SQL} SELECT row_id, label, base_id, neighbour_id, round(u, 6) AS u FROM made",
)
def _draws(spark, sf_dir) -> DataFrame:
    return r6(resample.smote_draws(vectors(spark, sf_dir)).drop("vec"))


@query(
    "smote_oversample",
    f"""WITH {SMOTE_SQL},
grown AS (SELECT row_id, label, vec, false AS synthetic FROM vectors UNION ALL SELECT row_id, label, vec, true FROM made)
SELECT row_id, label, synthetic, CAST(unnest(range(64)) AS INTEGER) AS dim, round(unnest(vec), 6) AS x FROM grown""",
)
def _smote(spark, sf_dir) -> DataFrame:
    grown = resample.smote_oversample(vectors(spark, sf_dir))
    return r6(grown.select("row_id", "label", "synthetic", F.posexplode("vec").alias("dim", "x")))


@query(
    "enn_clean",
    f"""WITH {VECTORS_SQL}, {_knn_sql('vectors', 5)},
bad AS (SELECT k.row_id FROM knn k JOIN vectors v USING (row_id) WHERE k.nl <> v.label)
SELECT row_id, label FROM vectors WHERE label = 1 OR row_id NOT IN (SELECT row_id FROM bad)""",
)
def _enn(spark, sf_dir) -> DataFrame:
    return resample.enn_clean(vectors(spark, sf_dir), clean_labels=[0]).select("row_id", "label")


@query(
    "smote_enn",
    f"""WITH {SMOTE_SQL},
grown AS (SELECT row_id, label, vec, false AS synthetic FROM vectors UNION ALL SELECT row_id, label, vec, true FROM made),
{_knn_sql('grown', 5)},
bad AS (SELECT k.row_id FROM knn k JOIN grown v USING (row_id) WHERE k.nl <> v.label)
SELECT row_id, label, synthetic FROM grown WHERE row_id NOT IN (SELECT row_id FROM bad)""",
)
def _smote_enn(spark, sf_dir) -> DataFrame:
    out = resample.smote_enn(vectors(spark, sf_dir), clean_labels=[0, 1])
    return out.select("row_id", "label", "synthetic")


@query(
    "enn_two_radii",
    f"""WITH {VECTORS_SQL}, {_knn_sql('vectors', 5)},
bad AS (SELECT k.row_id FROM knn k JOIN vectors v USING (row_id) WHERE k.nl <> v.label)
SELECT row_id, label FROM vectors WHERE row_id NOT IN (SELECT row_id FROM bad)""",
)
def _enn_two_radii(spark, sf_dir) -> DataFrame:
    """Both classes cleaned through many cells, by the two-radius join."""
    rows = edited.clean_by_two_radii(vectors(spark, sf_dir), clean_labels=[0, 1], chunk_rows=64)
    return rows.select("row_id", "label")
