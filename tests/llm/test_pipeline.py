"""Each stage against brute force over its own input, and the whole run."""

import importlib

import pytest
from pyspark.sql import functions as F

from bescheid.llm import quality, secret_scan

pipe = importlib.import_module("corpus_pipeline")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_order():
    assert [n for n, _ in pipe.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]


def test_quality_stage(spark, docs):
    kept = pipe.good_documents(spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids == {r.doc_id for r in docs.collect() if model.scores([r.text])[0] >= 0.5}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in ids for d in good) / len(good) > 0.98 and sum(d in ids for d in labels if labels[d] == 0) < 0.1 * (len(labels) - len(good))


def test_secret_stage(spark, docs):
    out = {r.doc_id: r for r in pipe.without_secrets(spark, docs, SF).collect()}
    found = 0
    for r in docs.collect():
        spans = secret_scan.scan([r.text])[0]
        found += bool(spans)
        assert out[r.doc_id].text == secret_scan.redacted(r.text, spans) and out[r.doc_id].n_chars == len(out[r.doc_id].text)
    assert found and len(out) == docs.count()


def test_odd_rows(spark, odd, none):
    assert pipe.without_secrets(spark, odd, SF).columns == ["doc_id", "text", "score", "node"]
    assert pipe.without_secrets(spark, none, SF).count() == 0


def test_odd_rows_quality(spark, odd, none):
    assert pipe.good_documents(spark, odd, SF).columns == odd.columns
    assert pipe.good_documents(spark, none, SF).count() == 0
    assert pipe.packed(spark, none, SF).count() == 0


def test_run(spark, docs):
    out = pipe.run(spark, SF)
    step = docs
    for _, stage in pipe.STAGES[:-1]:
        step = stage(spark, step, SF).cache()
    tokens = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert set(tokens) == {r.doc_id for r in step.collect()}
    total = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("k"), F.count("*").alias("c")).collect()
    assert all(r.n <= 4096 and r.k == r.c for r in total)
