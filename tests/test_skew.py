"""Frequent keys: the spread-out join must equal the plain one, and no task may get a whole key."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import dedupe, duplicate_keys, rank_rows
from tidemark.operators import first_rows
from tidemark.operators.keys import assert_unique
from tidemark.operators.skew import join_many_to_one


@pytest.fixture(scope="module")
def many(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(30_000).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def one(spark):
    return spark.createDataFrame([(7, "hot"), (8, "cold"), (11, "x"), (None, "null")], "k bigint, w string")


SMALL = {"spark.sql.shuffle.partitions": "50", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_frequent_keys_are_split(many, one, skewed, how, null_safe):
    joined = join_many_to_one(many.repartition(12), one, ["k"], how=how, null_safe=null_safe)
    columns = ["t.k", "t.v"] + ([] if how.startswith("left_") else ["s.w"])
    found = rows(joined.select(*columns))
    text = {7: "hot", 8: "cold", 11: "x"} | ({None: "null"} if null_safe else {})
    want = [(r["k"], r["v"], text.get(r["k"])) for r in many.collect()]
    if how in ("inner", "left_semi"):
        want = [w for w in want if w[2]]
    if how == "left_anti":
        want = [w for w in want if not w[2]]
    want = [w[:2] for w in want] if how.startswith("left_") else want
    assert found == sorted(want, key=lambda r: [(v is None, v) for v in r])
    done = joined.select(*columns)
    done.collect()
    assert "skew=true" in done._jdf.queryExecution().executedPlan().toString() or not null_safe and how in ("inner", "left_semi")


def test_dedupe_aggregates_before_the_shuffle(many):
    plan = dedupe(many, ["k"], "last", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange") and "Window" not in plan


def test_dedupe_keeps_first_or_last_and_null_keys(spark, many):
    last = {r["k"]: r["v"] for r in dedupe(many, ["k"], "last", ["v"]).filter("k = 7 OR k IS NULL").collect()}
    assert last == {7: 29_997, None: 29_998}
    assert dedupe(many, ["k"], "first", ["v"], nulls_match=False).filter("k IS NULL").count() == 10_000
    maps = spark.createDataFrame([(1, 2, {"a": 1}), (1, 3, {"b": 1})], "k int, o int, m map<string,int>")
    assert rows(dedupe(maps, ["k"], "first", ["o"]).select("k", F.map_keys("m"))) == [(1, ["a"])]
    with pytest.raises(ValueError, match="on_duplicate"):
        dedupe(maps, ["k"], "any")


def test_duplicate_keys(many):
    assert rows(duplicate_keys(many, ["k"])) == [(7, 10_000), (None, 10_000)]
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(many, ["k"])
    assert_unique(many, ["v"])


def test_ranks_over_many_partitions(spark):
    df = spark.range(50_000).repartition(7).select("id", F.xxhash64("id").alias("o"))
    ranked = rank_rows(df, ["o"])
    assert ranked.agg(F.min("__rank"), F.max("__rank"), F.countDistinct("__rank")).first() == (1, 50_000, 50_000)
    expected = [r["id"] for r in df.orderBy("o").collect()]
    assert [r["id"] for r in ranked.orderBy("__rank").collect()] == expected
    assert rank_rows(df.limit(0), ["o"]).count() == 0


def test_first_rows(spark):
    df = spark.range(1000)
    assert rows(first_rows(df, [F.col("id").desc()], 10, 5)) == [(i,) for i in range(985, 995)]
    assert first_rows(df, ["id"], 0).count() == 0 and first_rows(df, ["id"], 10_000, 990).count() == 10


def test_the_check_reads_keys_and_serves_the_join(spark, tmp_path, skewed):
    spark.range(100).selectExpr("id", "id AS a", "id AS b").write.parquet(str(tmp_path / "s"))
    checked = dedupe(spark.read.parquet(str(tmp_path / "s")), ["id"])
    plan = checked.select("id", "a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,a:bigint>" in plan
    joined = spark.range(50).join(checked, "id")._jdf.queryExecution().executedPlan().toString()
    assert joined.count("Exchange hashpartitioning") == 2 and joined.count("Sort [") == 2
    with pytest.raises(Exception, match="more than one source row"):
        dedupe(checked.union(checked), ["id"]).count()
