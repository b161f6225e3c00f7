"""How the provided tables play the part of a labelled panel.

Each view has a Spark form here and the same expressions in SQL below, so that
the checking SQL starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.roles import ColumnRoles
from panelwise.session import tune

FEATURES = ("reading", "level", "hour_of_day", "day_no", "code")
ROLES = ColumnRoles().with_features(*FEATURES)
PANEL_START = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a panel: entity = user, time = hours since the start.

    ``reading`` is missing for sign-ups and ``level`` below 10, so both features
    have gaps in different rows.
    """
    tune(spark)
    ev = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(
        F.lit(PANEL_START).cast("timestamp")
    )
    hour = F.floor(micros / F.lit(3.6e9)).cast("int")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").cast("string").alias("entity"),
        hour.alias("hour"),
        ((F.col("event_type") == "error") & (F.col("value") > 150)).cast("int").alias("label"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("reading"),
        F.when(k >= 10, k.cast("double")).alias("level"),
        (hour - F.floor(hour / F.lit(24)) * 24).cast("double").alias("hour_of_day"),
        F.floor(hour / F.lit(24)).cast("double").alias("day_no"),
        k.cast("double").alias("code"),
        F.col("event_type").alias("kind"),
        (F.floor(F.least(F.col("value"), F.lit(500.0)) / 5.0) / 100.0).alias("p"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with a score in [0, 1] that has many ties, and its prediction at 0.35."""
    return panel(spark, sf_dir).withColumn("yhat", (F.col("p") > F.lit(0.35)).cast("int"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as doubles; the rare class is label 0."""
    tune(spark)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        (F.col("label") == 0).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a wide numeric table with one derived column per relation."""
    tune(spark)
    li = table(spark, sf_dir, "lineitem")
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    return li.select(
        F.col("l_quantity").alias("quantity"),
        price.alias("price"),
        disc.alias("discount"),
        F.col("l_tax").alias("tax"),
        (price * (F.lit(1.0) - disc)).alias("net"),
        (F.col("l_quantity") * disc).alias("saving"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


LINE_FEATURES = ("quantity", "price", "discount", "tax", "net", "saving")

PANEL_SQL = """panel0 AS (
  SELECT event_id, user_id, event_type, value,
         CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 3.6e9) AS INTEGER) AS hour,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
panel AS (
  SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS entity, hour,
         CASE WHEN event_type = 'error' AND value > 150 THEN 1 ELSE 0 END AS label,
         CASE WHEN event_type <> 'signup' THEN value END AS reading,
         CASE WHEN k >= 10 THEN CAST(k AS DOUBLE) END AS level,
         CAST(hour - floor(hour / 24.0) * 24 AS DOUBLE) AS hour_of_day,
         CAST(floor(hour / 24.0) AS DOUBLE) AS day_no,
         CAST(k AS DOUBLE) AS code,
         event_type AS kind,
         floor(least(value, CAST(500 AS DOUBLE)) / 5) / 100 AS p
  FROM panel0),
scored AS (
  SELECT *, CASE WHEN p > CAST(0.35 AS DOUBLE) THEN 1 ELSE 0 END AS yhat FROM panel)"""

VECTORS_SQL = """vectors AS (
  SELECT vec_id AS row_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS label,
         CAST(embedding AS DOUBLE[]) AS vec
  FROM embeddings)"""

LINES_SQL = """lines AS (
  SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
         l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) AS net,
         l_quantity * l_discount AS saving,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
  FROM lineitem)"""
