"""Each stage of the pipeline on its own input, against brute force on the smallest tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import public_tokenizers as tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from panelwise.llm import bpe
from test_pairs import kept_lines, leaks, simgroups  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, folder = [docs], tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def texts(table):
    return [(r.doc_id, r.text) for r in table.collect()]


def test_columns_stay_until_the_last_stage(outputs):
    for table in outputs[1:-1]:
        assert table.columns == outputs[0].columns and dict(table.dtypes) == dict(outputs[0].dtypes)


def test_classifier_keeps_good_documents(spark, outputs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {k for k, _ in texts(outputs[1])}
    good = [k for k, q in labels.items() if q]
    assert sum(k in kept for k in good) > 0.98 * len(good)
    assert sum(k in kept for k, q in labels.items() if not q) < 0.1 * (len(labels) - len(good))


def test_lines(outputs):
    want = {k: text for k, _, _, text in kept_lines(texts(outputs[1]))}
    rows = outputs[2].collect()
    assert {str(r.doc_id): r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_one_of_each_group(outputs):
    given = texts(outputs[2])
    firsts = {c for _, _, c in simgroups(given)}
    assert sorted(texts(outputs[3])) == sorted(x for x in given if x[0] in firsts)


def test_contaminated_documents_go(spark, outputs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    given = texts(outputs[3])
    bad = {k for k, _, hit, _ in leaks(given, items) if hit}
    assert sorted(texts(outputs[4])) == sorted(x for x in given if str(x[0]) not in bad)


def test_tokens(outputs):
    words = bpe.vocabulary(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    judge = tiktoken.Encoding("judge", pat_str=tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in outputs[5].collect()}
    assert got.keys() == {k for k, _ in texts(outputs[4])}
    for key, text in texts(outputs[4]):
        ids = judge.encode_ordinary(text)
        assert got[key] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_run_gives_the_last_stage(spark, outputs):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, outputs[5].collect()))


def test_stages_on_odd_rows_and_on_none(spark, odd, empty):
    shape = spark.read.parquet(f"{SF}/documents.parquet").columns
    for table in (odd, empty):
        docs = table.selectExpr("doc_id", "text", "lang", "cast(null AS string) AS source", "cast(null AS bigint) AS n_chars")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == shape and out.count() <= docs.count()
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_columns_of_the_caller_stay(spark):
    """Columns with the names that stages use for themselves, and no n_chars, come through every stage."""
    names = "n_lines", "n_removed", "_kept", "kept", "quality", "keep", "fingerprint", "component_id", "n_hit", "items"
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars").limit(60)
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    rows = docs.collect()
    assert rows and set(docs.columns) == {"doc_id", "text", "lang", "source", *names}
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)
