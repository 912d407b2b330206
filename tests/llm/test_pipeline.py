"""The pipeline on planted cases: what each stage must drop goes, clean documents go through every filter."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "shard"]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs.limit(30), FOLDER).columns == docs.columns, name


def test_planted_cases(spark, docs):
    random.seed(4)
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    clean = docs.filter("n_chars > 1500").limit(1).first()["text"]
    words = clean.split()
    words[len(words) // 2] = "changed"
    planted = [(100_001, clean + " tail", "en"), (100_002, " ".join(words), "en"), (100_003, "12 34 ... 56", "en"), (100_004, None, None), (100_005, f"{clean[:700]} {bench} {clean[700:1400]}", "en")]
    rows = spark.createDataFrame([(i, t, l, "src0", len(t or "")) for i, t, l in planted], docs.schema)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stage = dict(corpus_pipeline.STAGES)
    everything = docs.union(rows)
    kept = stage["language_id"](spark, everything, FOLDER)
    assert ids(everything) - ids(kept) == {100_003, 100_004}
    kept = stage["near_dedup"](spark, everything, FOLDER)
    assert not {100_001, 100_002} & ids(kept) and {100_003, 100_004, 100_005} <= ids(kept)
    kept = stage["decontaminate"](spark, everything, FOLDER)
    assert 100_005 not in ids(kept) and {100_001, 100_002, 100_003, 100_004} <= ids(kept)


def test_run(spark, docs):
    found = corpus_pipeline.run(spark, FOLDER)
    shards = found.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    assert all(r["n"] == r["last"] + 1 == r["slots"] for r in shards) and found.count() < docs.count()


def test_empty(spark, docs):
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs.limit(0), FOLDER).collect() == []
