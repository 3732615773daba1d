"""Toxicity: what training may see, and held-out accuracy."""

import zlib

import numpy as np
from corpus_helpers import DATA
from pyspark.sql import functions as F

from commerce_lake.llm import queries, toxicity

LARGER = DATA.parent / "sf0.1"


def test_held_out_rows(docs):
    got = docs.select("doc_id", toxicity.fold("doc_id").alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 for r in got)


def test_training_separates_and_keeps_the_prior():
    rng = np.random.default_rng(0)
    clean = lambda: rng.choice(2000, 60, replace=False).astype(np.int32)
    bad = lambda: np.append(clean(), np.int32([3000 + k for k in rng.choice(8, 2, replace=False)]))
    model = toxicity.train([bad() for _ in range(200)], [bad() if rng.random() < 0.1 else clean() for _ in range(1500)], 0.1)
    score = lambda b: 1 / (1 + np.exp(-(model.bias + model.weights[b].sum())))
    assert np.mean([score(bad()) > 0.3 for _ in range(200)]) > 0.95
    assert np.mean([score(clean()) > 0.3 for _ in range(200)]) < 0.02
    empty = toxicity.train([], [], 0.0)
    assert 0 <= empty.score("anything") < 0.3


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.fold("doc_id") == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x) for x in (labels, turned))
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_edge_cases(docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).count() == 0


def test_held_out_accuracy(spark):
    got = queries.op7_toxicity(spark, str(LARGER)).where("held_out")
    rows = got.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.9
    assert hit / sum(r.toxic for r in rows) > 0.75
