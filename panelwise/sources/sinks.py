"""Tables of metrics and hyper-parameters, and their JSON form."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.session import small_frame

METRIC_SCHEMA = "run_id string, model string, metric string, value double"
PARAMS_SCHEMA = "run_id string, model string, params map<string,string>"


def save_metrics(
    spark: SparkSession, metrics: Mapping[str, float | None], model: str, run_id: str, path: str,
    fmt: str = "parquet",
) -> None:
    """Append one row per metric."""
    rows = [(run_id, model, k, None if v is None else float(v)) for k, v in metrics.items()]
    small_frame(spark, rows, METRIC_SCHEMA).coalesce(1).write.mode("append").format(fmt).save(path)


def read_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per run and model, metrics as a map."""
    rows = spark.read.schema(METRIC_SCHEMA).format(fmt).load(path)
    pairs = F.collect_list(F.struct("metric", "value"))
    return rows.groupBy("run_id", "model").agg(F.map_from_entries(pairs).alias("metrics"))


def save_hyperparameters(
    spark: SparkSession, params: Mapping[str, Any], model: str, run_id: str, path: str, fmt: str = "parquet"
) -> None:
    text = {k: None if v is None else str(v) for k, v in params.items()}
    frame = spark.createDataFrame([(run_id, model, text)], PARAMS_SCHEMA)
    frame.coalesce(1).write.mode("append").format(fmt).save(path)
