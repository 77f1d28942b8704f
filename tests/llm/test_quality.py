"""Held-out accuracy of the classifier, and odd inputs."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from presskiln.llm import quality


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.op4_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    rows = [r for r in rows if r["held_out"]]
    for label, least in ((1, 0.98), (0, 0.93)):
        own = [r["predicted"] == label for r in rows if r["quality"] == label]
        assert np.mean(own) >= least, (label, np.mean(own), len(own))
    assert docs.count() == quality.op4_quality(spark, "/root/testdata/sf0.1").count()


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias and one.weights.any()


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b"), (3, "x " * 50000)], "doc_id long, text string")
    docs = docs.withColumn("quality", F.lit("clash")).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (3, 7, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    found = quality.score(docs, model).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 and r["quality"] == "clash" for r in found)
    assert quality.score(docs.limit(0), model).count() == 0
    assert 0 < quality.train(docs, labels.limit(0)).scores([b""])[0] < 1


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.append(rng.integers(4, 40, 6), k % 2)) for k in range(200)]
    labels = np.where(np.arange(200) % 2 == 0, 1.0, -1.0)
    weights = quality.dual_descent(rows, np.ones(40), labels, np.ones(200), 20)
    margins = np.array([weights[r].sum() + weights[-1] for r in rows])
    assert (margins * labels > 0.99).mean() > 0.99
