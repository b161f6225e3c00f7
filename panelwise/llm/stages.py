"""Stages of the corpus pipeline; each takes (spark, docs, sf_dir) and works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.llm import bpe, decontam, line_dedup, quality, simhash
from panelwise.llm.common import fresh, prepare, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on these same ones, does not reject."""
    prepare(spark)
    return quality.score(docs, quality.fit(docs), keep_only=True)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated lines; n_chars, if there is one, is that of the new text.

    Every document stays, also one that has no line left.
    """
    prepare(spark)
    added = ("n_lines", "n_removed")
    kept, *aside = fresh(docs, "kept", *added)
    aside = {c: new for c, new in zip(added, aside) if c in docs.columns}
    rows = line_dedup.remove_repeated_lines(docs.withColumnsRenamed(aside), kept=kept)
    rows = rows.drop(*added).withColumnsRenamed({new: c for c, new in aside.items()})
    new = {"text": F.col(kept)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(kept).cast(docs.schema["n_chars"].dataType)
    return rows.withColumns(new).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates."""
    prepare(spark)
    return simhash.keep_first(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no window of a benchmark item occurs."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the tokens and of the bytes decoded from them."""
    prepare(spark)
    return bpe.round_trip(docs, tokenizers.path(VOCABULARY), tokenizers.PATTERN)
