"""The corpus pipeline: stages over the documents, each written and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelwise.llm import stages
from panelwise.llm.common import table
from panelwise.session import session_folder

#: Each function takes (spark, docs, sf_dir).
STAGES = [
    ("quality classifier", stages.keep_good),
    ("line dedup", stages.drop_repeated_lines),
    ("simhash near-dedup", stages.keep_one_of_each_group),
    ("benchmark decontamination", stages.drop_contaminated),
    ("byte-level BPE", stages.encode),
]

#: SQL can express neither the trained classifier nor the merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{session_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}")
        docs = spark.read.parquet(path)
    return docs
