import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import dominant_topic, draw, margins, mix


@pytest.fixture(scope="module")
def docs(spark):
    return spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("big")).when(F.col("id") % 30 == 0, F.lit(None)).otherwise("mid").alias("source"),
        F.when(F.col("id") % 7 < 5, "en").otherwise("de").alias("lang"), (F.col("id") % 11 + 5).alias("n"), F.lit("kept").alias("rate"))


def _mix(docs, **options):
    return mix(docs, {"source": F.col("source"), "lang": F.col("lang")}, options.pop("exponents", {"source": 0.5, "lang": 0.5}), F.col("n"), **options)


def test_expected_tokens_meet_the_margins(docs):
    found = _mix(docs, budget=0.1, rounds=20)
    for column in ("source", "lang"):
        sums = found.groupBy(column).agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("__rate")).alias("wanted"), F.sum(F.when(F.col("__sampled"), F.col("n"))).alias("drawn")).collect()
        total, parts = sum(r["all"] for r in sums), sum(r["all"] ** 0.5 for r in sums)
        for r in sums:
            assert r["wanted"] == pytest.approx(0.1 * total * r["all"] ** 0.5 / parts, rel=1e-3)
            assert abs(r["drawn"] - r["wanted"]) < 0.15 * r["wanted"]
    assert found.agg(F.max("__rate")).first()[0] < 1


def test_margins_tell_what_is_missed(docs):
    dimensions, exponents = {"source": F.col("source"), "lang": F.col("lang")}, {"source": 0.5, "lang": 0.5}
    met = {(r["dimension"], r["value"]): r for r in margins(docs, dimensions, exponents, F.col("n"), 0.1, 20).collect()}
    assert set(met) == {("source", "big"), ("source", "mid"), ("source", None), ("lang", "en"), ("lang", "de")}
    assert all(r["residual"] < 1e-3 for r in met.values())
    missed = {(r["dimension"], r["value"]): r for r in margins(docs, dimensions, {"source": 0.0, "lang": 1.0}, F.col("n"), 0.9).collect()}
    small = missed["source", None]
    assert small["expected"] == pytest.approx(small["tokens"], rel=0.02) and small["residual"] > 0.5


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "x", 3, 7, 8)], "doc_id long, source string, lang string, n long, __dim_0 int, __rate int")
    found = _mix(df)
    assert found.columns == ["doc_id", "source", "lang", "n", "__dim_0", "__tokens", "__rate", "__sampled"] and found.first()["__dim_0"] == 7


def test_a_small_value_is_taken_whole(docs):
    rates = {r["source"]: r["rate"] for r in _mix(docs, budget=0.9, exponents={"source": 0.0, "lang": 1.0}).groupBy("source").agg(F.min("__rate").alias("rate")).collect()}
    assert rates[None] == pytest.approx(1, abs=0.02)


def test_the_same_documents_whatever_the_partitions(docs):
    one, two = (sorted(r[0] for r in _mix(d).filter("__sampled").select("doc_id").collect()) for d in (docs, docs.repartition(9)))
    assert one == two and 0 < len(one) < 20_000
    assert _mix(docs).columns == docs.columns + ["__tokens", "__rate", "__sampled"]
    assert _mix(docs, seed="other").filter("__sampled").count() != len(one)


def test_edges(spark):
    schema = "doc_id long, source string, lang string, n long"
    assert _mix(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, None, 0), (1, "a", None, 0), (1, "a", None, 0), (2, "a", "x", 10), (3, "a", "x", 10)]
    found = _mix(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 5 and all(0 <= r["__rate"] <= 1 for r in found)
    same = [r["__sampled"] for r in found if r["doc_id"] == 1]
    assert same[0] == same[1]


def test_draws_and_topics(spark):
    spread = spark.range(10_000).select(draw(F.col("id")).alias("u")).agg(F.min("u"), F.avg("u"), F.max("u")).first()
    assert 0 <= spread[0] < 0.01 and abs(spread[1] - 0.5) < 0.02 and 0.99 < spread[2] < 1
    df = spark.createDataFrame([("aab",), ("abb",), ("ab",), ("c",), (None,), ("",), ("x" * 100_000 + "bb",)], "t string")
    topic = dominant_topic(F.col("t"), {"A": "a", "B": "b"}, "none")
    assert [r[0] for r in df.select(topic).collect()] == ["A", "B", "A", "none", "none", "none", "B"]
