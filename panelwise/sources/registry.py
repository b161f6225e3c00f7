"""Versioned models: saved pipelines and a table of their versions."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from panelwise.functions.scalar import NAME_PATTERN
from panelwise.session import create_file, path_exists, remove_path

VERSION_SCHEMA = (
    "name string, key string, version string, seq int, timestamp string, metrics map<string,double>, "
    "params map<string,string>, tags array<string>, model_path string, artifacts map<string,string>, "
    "deleted boolean"
)
_DOCUMENT_SCHEMA = (
    "models map<string, array<struct<name: string, version: string, timestamp: string, "
    "metrics: map<string,double>, params: map<string,string>, tags: array<string>, "
    "model_path: string, artifacts: map<string,string>>>>"
)


def read_registry_json(spark: SparkSession, path: str) -> DataFrame:
    """Versions of a registry document, one row per version.

    Bare NaN is read; ``seq`` is the place of the version in its list.
    """
    document = spark.read.schema(_DOCUMENT_SCHEMA).option("multiLine", True).json(path)
    lists = document.select(F.explode("models").alias("key", "versions"))
    return lists.select("key", F.posexplode("versions").alias("seq", "v")).select("key", "seq", "v.*")


def latest_version(versions: DataFrame, key: str = "key") -> DataFrame:
    """The last version of every model."""
    last = F.max_by(F.struct("*"), F.col("seq"))
    return versions.groupBy(F.col(key).alias("_k")).agg(last.alias("_r")).select("_r.*")


def best_version(
    versions: DataFrame, metric: str, higher_is_better: bool = True, key: str = "key"
) -> DataFrame:
    """The best version of every model that has the metric; ties go to the first."""
    value = F.col("metrics")[metric]
    known = versions.filter(value.isNotNull() & ~F.isnan(value))
    # max_by on (value, -seq): one aggregate with partial results, no sort.
    rank = F.struct(value if higher_is_better else -value, -F.col("seq"))
    best = F.max_by(F.struct("*"), rank)
    return known.groupBy(F.col(key).alias("_k")).agg(best.alias("_r")).select("_r.*")


class ModelRegistry:
    """Save, find, load and delete model versions under one folder.

    The table is append-only; a deletion appends a tombstone.  A version number
    belongs to the writer that creates its claim file, so two never get the same.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._table = f"{self.root}/versions"

    def _rows(self) -> DataFrame:
        if not path_exists(self.spark, self._table):
            return self.spark.createDataFrame([], VERSION_SCHEMA)
        return self.spark.read.schema(VERSION_SCHEMA).parquet(self._table)

    def versions(self, name: str | None = None) -> DataFrame:
        """Living versions, of all models or of one."""
        rows = self._rows()
        gone = rows.filter("deleted").select("key", "seq")
        living = rows.filter("NOT deleted").join(gone, ["key", "seq"], "left_anti").select(*rows.columns)
        return living if name is None else living.filter(F.col("key") == _key(name))

    def list_models(self) -> DataFrame:
        """name, number of versions, latest version."""
        return self.versions().groupBy("key").agg(
            F.count(F.lit(1)).alias("n_versions"), F.max_by("version", "seq").alias("latest")
        )

    def save_model(
        self,
        model: PipelineModel,
        name: str,
        params: Mapping[str, Any],
        metrics: Mapping[str, float],
        artifacts: Mapping[str, str] | None = None,
        tags: Sequence[str] = (),
    ) -> Row:
        """Write the model, then its row; the version is one above any used before."""
        key = _key(name)
        used = self._rows().filter(F.col("key") == key).agg(F.max("seq")).first()[0]
        seq = (used or 0) + 1
        while not create_file(self.spark, f"{self.root}/claims/{key}/{seq}"):
            seq += 1
        stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
        path = f"{self.root}/models/{key}_{stamp}_{uuid.uuid4().hex[:6]}"
        model.write().save(path)
        row = (
            name, key, f"v{seq}", seq, stamp, {k: float(v) for k, v in metrics.items()},
            {k: None if v is None else str(v) for k, v in params.items()}, list(tags), path,
            dict(artifacts or {}), False,
        )
        self._append([row])
        return self.versions(name).filter(F.col("seq") == seq).first()

    def _append(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(self._table)

    def _known(self, name: str) -> DataFrame:
        found = self.versions(name)
        if found.isEmpty():
            raise ValueError(f"model not found: {name}")
        return found

    def _load(self, row: Row | None, missing: str) -> tuple[PipelineModel, Row]:
        if row is None:
            raise ValueError(missing)
        if not path_exists(self.spark, row["model_path"]):
            raise FileNotFoundError(row["model_path"])
        return PipelineModel.load(row["model_path"]), row

    def load_model(self, name: str, version: str | None = None) -> tuple[PipelineModel, Row]:
        """The named version, or the latest."""
        found = self._known(name)
        chosen = latest_version(found) if version is None else found.filter(F.col("version") == version)
        return self._load(chosen.first(), f"version {version} not found: {name}")

    def best_model(
        self, name: str, metric: str, higher_is_better: bool = True
    ) -> tuple[PipelineModel, Row]:
        best = best_version(self._known(name), metric, higher_is_better).first()
        return self._load(best, f"no version of {name} has {metric}")

    def delete_model(self, name: str, version: str | None = None) -> None:
        """Delete one version, or all, with its files."""
        found = self._known(name)
        rows = (found if version is None else found.filter(F.col("version") == version)).collect()
        if not rows:
            raise ValueError(f"version {version} not found: {name}")
        self._append([(*[r[c] for c in r.asDict() if c != "deleted"], True) for r in rows])
        for r in rows:
            remove_path(self.spark, r["model_path"])


def _key(name: str) -> str:
    return re.sub(NAME_PATTERN, "_", name)
