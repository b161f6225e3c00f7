from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelwise.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    rows = entry.queries()["op8_quality_classifier"](spark, SF)
    return rows.withColumnRenamed("quality", "score").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()


def test_agrees_with_labels_it_has_not_seen(judged):
    good = judged.quality == 1
    assert judged.keep[good].mean() > 0.99 and (~judged.keep[~good]).mean() > 0.95


def test_well_formed_toxic_texts_are_of_good_quality(judged):
    assert judged.keep[(judged.quality == 1) & (judged.toxic == 1)].mean() > 0.95


def test_em_finds_planted_rates():
    draw = np.random.default_rng(1)
    n, k = 40_000, len(quality.LABELLERS)
    bad = draw.random(n) < 0.3
    hit = np.linspace(0.5, 0.8, k)
    votes = np.where(bad[:, None], draw.random((n, k)) < hit, draw.random((n, k)) < 0.001)
    pattern, count = np.unique(votes @ (1 << np.arange(k)), return_counts=True)
    model = quality.fit_label_model(pattern, count)
    assert abs(model.bad - 0.3) < 0.02 and np.abs(model.hit - hit).max() < 0.03 and model.false.max() < 0.003


def test_odd_rows_give_a_result_each(odd, odd_rows, empty):
    model = quality.fit(odd)
    got = quality.score(odd, model)
    assert got.count() == len(odd_rows) and got.filter("quality IS NULL OR keep IS NULL").count() == 0
    same = got.filter("doc_id IN (1, 10)").select("quality").distinct().count()
    assert same == 1 and got.filter("doc_id = 8").first().alarms > 0
    assert quality.score(odd, model, keep_only=True).columns == odd.columns
    assert quality.score(empty, quality.fit(empty)).count() == 0


def test_sample_does_not_depend_on_partitions(spark, many_partitions):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    one = quality.fit(docs.coalesce(1), sample=200)
    many = quality.fit(docs.repartition(9), sample=200)
    assert np.allclose(one.weights, many.weights, atol=1e-3) and abs(one.labels.bad - many.labels.bad) < 1e-9


def test_equal_rows_reach_the_driver_once(spark, monkeypatch):
    different = spark.range(2000).selectExpr("id AS doc_id", "concat('row number ', id, ' has its own words') AS text")
    same = spark.range(30_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'page not found' AS text")
    sizes = []
    real = quality.fit_scorer
    monkeypatch.setattr(quality, "fit_scorer", lambda number, spot, value, bad: sizes.append(len(bad)) or real(number, spot, value, bad))
    quality.fit(different.unionByName(same), sample=500)
    quality.fit(different.unionByName(same), sample=5_000)
    assert sizes[0] < 800 and 1900 < sizes[1] <= 2001


def test_rows_of_very_many_words_are_not_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_FEATURES", 50)
    rows = [(k, " ".join(f"w{i}" for i in range(100 if k < 5 else 9))) for k in range(40)]
    sizes = []
    real = quality.fit_scorer
    monkeypatch.setattr(quality, "fit_scorer", lambda number, spot, value, bad: sizes.append(len(bad)) or real(number, spot, value, bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert quality.score(docs, quality.fit(docs)).count() == 40 and sizes == [35]
