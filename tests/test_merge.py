import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import enum_to_text
from tidemark.sources import from_rows
from tidemark import TableSpec, append_rows, delete, insert, insert_absent, merge, sync, table_diff, update, upsert

SCHEMA = "id bigint, name string, qty int, price double, at timestamp_ntz"
SPEC = TableSpec("item", key=("id",))
T0 = dt.datetime(2024, 1, 1)


def items(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


@pytest.fixture
def target(spark):
    return items(spark, (1, "a", 1, 1.0, T0), (2, "b", None, 2.0, T0), (3, None, 3, float("nan"), T0), (4, "d", 4, -0.0, T0))


@pytest.fixture
def source(spark):
    return items(spark, (2, "b", None, 2.0, T0), (3, "c", 3, float("nan"), T0), (4, "d", 4, 0.0, T0), (5, "e", 5, 5.0, T0))


def actions(result):
    return rows(result.changes, "__action", "id")


@pytest.mark.parametrize("strategy", ["auto", "outer", "split"])
def test_upsert(target, source, strategy):
    result = upsert(target, source, SPEC, strategy=strategy)
    assert actions(result) == [("I", 5), ("U", 3)]
    assert rows(result.result, "id", "name") == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert result.stats.first().asDict() == {"inserted": 1, "updated": 1, "deleted": 0}


@pytest.mark.parametrize("strategy", ["outer", "split"])
def test_second_run_changes_nothing(target, source, strategy):
    once = upsert(target, source, SPEC, strategy=strategy).result
    assert upsert(once, source, SPEC, strategy=strategy).stats.first() == (0, 0, 0)
    gone = delete(target, source, SPEC).result
    assert delete(gone, source, SPEC).stats.first() == (0, 0, 0)


@pytest.mark.parametrize("strategy", ["outer", "split"])
def test_sync_leaves_the_source(target, source, strategy):
    result = sync(target, source, SPEC, strategy=strategy)
    assert actions(result) == [("D", 1), ("I", 5), ("U", 3)]
    assert rows(result.result, "id", "name", "qty") == rows(source, "id", "name", "qty")


def test_empty_source(target, source):
    none = source.limit(0)
    assert sync(target, none, SPEC).result.count() == 0
    assert upsert(target, none, SPEC).result.count() == 4
    assert delete(target, none, SPEC).result.count() == 4
    assert update(target, none, SPEC).stats.first() == (0, 0, 0)


def test_empty_target(target, source):
    none = target.limit(0)
    assert upsert(none, source, SPEC).stats.first() == (4, 0, 0)
    assert sync(none, source, SPEC).result.count() == 4


def test_counts_add_up(target, source):
    result = sync(target, source, SPEC, delete_filter="qty > 100")
    i, u, d = result.stats.first()
    assert result.result.count() == target.count() + i - d


def test_null_filter_is_not_true(target, source):
    # the only target-only row has qty 1; a filter that is NULL keeps it
    assert sync(target, source, SPEC, delete_filter=F.lit(None).cast("boolean")).result.count() == 5
    assert sync(target, source, SPEC, delete_filter=lambda t: t.qty == 1).result.count() == 4


def test_soft_delete_is_an_update_every_time(target, source):
    result = sync(target, source, SPEC, soft_delete={"qty": 0, "name": lambda t: F.concat(t.name, F.lit("!"))})
    assert ("U", 1) in actions(result)
    assert rows(result.result.filter("id = 1"), "name", "qty") == [("a!", 0)]
    again = sync(result.result, source, SPEC, soft_delete={"qty": 0})
    assert actions(again) == [("U", 1)]
    with pytest.raises(ValueError, match="unknown columns: nope"):
        sync(target, source, SPEC, soft_delete={"nope": 1})


def test_where_null_is_false(target, source):
    result = upsert(target, source, SPEC, where="t.qty > 100 OR s.name IS NULL")
    assert actions(result) == [("I", 5)]


def test_duplicate_source_keys(spark, target):
    twice = items(spark, (1, "x", 1, 1.0, T0), (1, "y", 2, 1.0, T0), (9, "z", 1, 1.0, T0))
    for operation in ("upsert", "update", "insert_absent", "sync"):
        with pytest.raises(PySparkException, match="more than one source row"):
            merge(target, twice, SPEC, operation).result.collect()
    assert ("y",) in rows(upsert(target, twice, SPEC, on_duplicate="last", ordinal="qty").result, "name")
    assert ("x",) in rows(upsert(target, twice, SPEC, on_duplicate="first", ordinal="qty").result, "name")
    with pytest.raises(ValueError, match="needs an ordinal"):
        upsert(target, twice, SPEC, on_duplicate="last")
    assert delete(target, twice, SPEC).result.count() == 3


def test_null_keys(spark):
    spec = TableSpec("k", key=("a", "b"), nullable=frozenset({"b"}))
    t = spark.createDataFrame([(1, None, "t"), (2, "x", "t"), (3, None, "t")], "a int, b string, v string")
    s = spark.createDataFrame([(1, None, "s"), (2, "x", "s"), (4, None, "s")], "a int, b string, v string")
    for strategy in ("outer", "split"):
        assert upsert(t, s, spec, strategy=strategy).stats.first() == (1, 2, 0)
        assert upsert(t, s, spec, strategy=strategy, null_safe_keys=False).stats.first() == (2, 1, 0)
        assert sync(t, s, spec, strategy=strategy, null_safe_keys=False).stats.first() == (2, 1, 2)
    # rows with a NULL key never match, so they are no duplicates either
    many = spark.createDataFrame([(1, None, "s"), (1, None, "s")], "a int, b string, v string")
    assert upsert(t, many, spec, null_safe_keys=False).stats.first() == (2, 0, 0)
    with pytest.raises(PySparkException, match="more than one source row"):
        upsert(t, many, spec).result.collect()


def test_a_match_key_that_repeats_in_the_target(spark):
    t = spark.createDataFrame([(i, "hot" if i < 50 else f"k{i}", 0) for i in range(100)], "id int, name string, v int")
    s = spark.createDataFrame([("hot", 1), ("k70", 1), ("new", 1)], "name string, v int")
    result = upsert(t, s, TableSpec("x", key=("id",)), match_on=["name"], exclude=["id"])
    assert result.stats.first() == (1, 51, 0)
    assert result.result.count() == 101


def test_binary_key_and_single_column(spark):
    t = spark.createDataFrame([(b"\x00\x01", "a")], "k binary, v string")
    s = spark.createDataFrame([(b"\x00\x01", "b"), (b"\x02", "c")], "k binary, v string")
    assert upsert(t, s, TableSpec("b", key=("k",))).stats.first() == (1, 1, 0)
    only = spark.createDataFrame([("a",)], "k string")
    more = spark.createDataFrame([("a",), ("b",)], "k string")
    assert upsert(only, more, TableSpec("o", key=("k",))).stats.first() == (1, 0, 0)


def test_no_key(target, source):
    keyless = TableSpec("log")
    assert upsert(target, source, keyless).stats.first() == (4, 0, 0)
    assert append_rows(target, source, SPEC).count() == 8
    with pytest.raises(ValueError, match="needs a key"):
        delete(target, source, keyless)


def test_arrays_structs_maps_are_compared(spark):
    schema = "id int, tags array<string>, attr struct<x:int>, m map<string,int>"
    t = spark.createDataFrame([(1, ["a"], (1,), {"p": 1, "q": 2}), (2, ["a"], (1,), {"p": 1})], schema)
    s = spark.createDataFrame([(1, ["a"], (1,), {"q": 2, "p": 1}), (2, ["b"], (1,), {"p": 1})], schema)
    for strategy in ("outer", "split"):
        assert actions(upsert(t, s, TableSpec("n", key=("id",)), strategy=strategy)) == [("U", 2)]


def test_case_insensitive_collation(spark):
    t = spark.sql("SELECT 1 AS id, 'ABC' COLLATE UTF8_LCASE AS name")
    s = spark.sql("SELECT 1 AS id, 'abc' COLLATE UTF8_LCASE AS name")
    assert upsert(t, s, TableSpec("c", key=("id",))).stats.first() == (0, 0, 0)


def test_version_conflicts(spark):
    spec = TableSpec("file", key=("id",), version="v")
    t = spark.createDataFrame([(i, "old", 1) for i in range(10)], "id int, d string, v bigint")
    s = spark.createDataFrame([(i, "new", 0 if i == 3 else 1) for i in range(10)], "id int, d string, v bigint")
    result = update(t, s, spec, check_version=True)
    assert result.skipped.first().asDict() == {"input_rows": 10, "output_rows": 9, "skipped": 1}
    assert rows(result.conflicts) == [(3, 1, 0)]
    assert rows(result.result, "v") == [(1,)] + [(2,)] * 9
    assert insert_absent(t.limit(0), s, spec).result.agg(F.max("v")).first()[0] == 1


def test_computed_default_and_period_columns(spark):
    spec = TableSpec("doc", key=("id",), defaults={"tag": "untagged"}, computed={"length": "length(text)"},
                     period=("since", "till"))
    schema = "id int, text string, tag string, length int, since timestamp_ntz, till timestamp_ntz"
    t = spark.createDataFrame([(1, "abc", "x", 3, T0, None)], schema)
    s = spark.createDataFrame([(1, "abcd", None), (2, "z", None)], "id int, text string, tag string")
    now = F.lit("2025-05-05").cast("timestamp_ntz")
    at = dt.datetime(2025, 5, 5)
    result = upsert(t, s, spec, exclude_on_update=["tag"], as_of=now).result
    assert rows(result) == [(1, "abcd", "x", 4, at, None), (2, "z", "untagged", 1, at, None)]
    mixed = spark.createDataFrame([(2, "z", None), (3, "y", "own")], "id int, text string, tag string")
    # one row has a value, so the column is not left to its default
    assert rows(insert_absent(t, mixed, spec).result, "id", "tag") == [(1, "x"), (2, None), (3, "own")]
    assert rows(insert_absent(t, mixed, spec, use_defaults="when_default").result, "id", "tag") == [
        (1, "x"), (2, "untagged"), (3, "own")]
    # a column absent from the source is filled on insert and left alone on update
    assert rows(upsert(t, s.drop("tag"), spec).result, "id", "tag") == [(1, "x"), (2, "untagged")]


def test_insert_conflicts(target, source):
    with pytest.raises(PySparkException, match="already has a row for key"):
        insert(target, source, SPEC).collect()
    with pytest.raises(PySparkException, match="already has a row for key"):
        insert(target, source, SPEC).count()
    assert insert(target, source.filter("id = 5"), SPEC).count() == 5
    keys = TableSpec("seen", key=("id",))
    with pytest.raises(PySparkException, match=r"'seen' already has a row for key \(1\)"):
        insert(target.select("id"), target.select("id").filter("id = 1"), keys).count()
    assert rows(insert(target, source, SPEC, "ignore"), "id", "name")[2] == (3, None)
    assert rows(insert(target, source, SPEC, "replace"), "id", "name")[2] == (3, "c")
    with pytest.raises(ValueError, match="on_conflict"):
        insert(target, source, SPEC, "maybe")


def test_replaced_keys_are_told_apart_once(target, source):
    """The check for duplicates has made the keys unique: a task need not hold them all again."""
    replaced = insert(target, source, SPEC, "replace")
    assert "Aggregate" not in replaced._jdf.queryExecution().executedPlan().toString()
    twice = insert(target, source.union(source), SPEC, "replace", on_duplicate="unchecked")
    assert rows(twice, "id") == [(1,), (2,), (2,), (3,), (3,), (4,), (4,), (5,), (5,)]


def test_null_keys_are_no_duplicates_unless_they_match(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    s = spark.createDataFrame([(None, "x"), (None, "y"), (1, "b")], "id int, v string")
    assert rows(upsert(t, s, TableSpec("n", key=("id",))).result) == [(1, "b"), (None, "x"), (None, "y")]
    with pytest.raises(PySparkException, match="more than one source row"):
        upsert(t, s, TableSpec("n", key=("id",), nullable=("id",))).result.count()


def test_source_preparation(spark, target):
    s = spark.createDataFrame([(1, "z", 7, "junk")], "code bigint, name string, qty int, other string")
    with pytest.raises(ValueError, match="unknown source columns: nope"):
        upsert(target, s, SPEC, column_mapping={"nope": "id"})
    with pytest.raises(ValueError, match="lacks columns: at, price"):
        upsert(target, s, SPEC, column_mapping={"code": "id"})
    settings = dict(column_mapping={"code": "id"}, include=["name", "qty"])
    assert rows(upsert(target, s, SPEC, **settings).result, "id", "name", "qty")[0] == (1, "z", 7)
    with pytest.raises(ValueError, match="not in 'item': other"):
        upsert(target, s, SPEC, strict=True, **settings)


def test_source_types_are_cast_to_the_targets(spark, target):
    s = spark.createDataFrame([("1", "a", 1.0, 1, "2024-01-01")], "id string, name string, qty double, price int, at string")
    result = upsert(target, s, SPEC)
    assert result.result.schema == target.schema
    assert result.stats.first() == (0, 0, 0)


def test_a_converted_key(spark):
    levels = TableSpec("level", key=("name",), converters={"name": enum_to_text({1: "low", 2: "mid", 3: "high"})})
    t = spark.createDataFrame([("low", "a"), ("mid", "b")], "name string, value string")
    s = spark.createDataFrame([(2, "B"), (3, "c")], "name int, value string")
    assert rows(upsert(t, s, levels, convert=True).result) == [("high", "c"), ("low", "a"), ("mid", "B")]
    assert rows(delete(t, s, levels, convert=True).result) == [("low", "a")]


def test_loaded_back_columns(spark):
    spec = TableSpec("e", key=("id",), identity="id", computed={"n": "length(name)"})
    t = spark.createDataFrame([(7, "x", 1)], "id int, name string, n int")
    s = spark.createDataFrame([(2, 0, "bb"), (1, None, "a"), (3, 7, "xyz")], "place int, id int, name string")
    result = upsert(t, s, spec, ordinal="place")
    assert rows(result.loaded_back()) == [(1, 8, "a", 1), (2, 9, "bb", 2), (3, 7, "xyz", 3)]
    assert result.loaded_back("identity").columns == ["__ordinal", "id"]
    assert result.loaded_back("included").columns == ["__ordinal", "id", "name"]
    assert dict(result.result.dtypes)["id"] == "int"


def test_staged_and_post_process(target, source):
    result = sync(target, source, SPEC).staged()
    seen = []
    result.post_process(lambda changes: seen.extend(rows(changes, "__action", "id")))
    assert seen == [("D", 1), ("I", 5), ("U", 3)]
    gone = delete(target, source, SPEC).staged()
    assert gone.result.count() == 1 and gone.stats.first() == (0, 0, 3) and gone.changes.count() == 3


def test_table_diff(target, source):
    assert rows(table_diff(target, source, SPEC), "__action", "id") == [("D", 1), ("I", 5), ("U", 3)]
    assert table_diff(target, target, SPEC).count() == 0


def test_join_hint_reaches_the_plan(target, source):
    text = update(target, source, SPEC, join_hint="merge").result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text
    text = update(target, source, SPEC, join_hint="broadcast").result._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text


def test_a_small_source_does_not_shuffle_the_target(spark, source):
    big = spark.range(2_000_000).select("id", F.lit("n").alias("name"), F.lit(1).alias("qty"),
                                        F.lit(1.0).alias("price"), F.lit(T0).cast("timestamp_ntz").alias("at"))
    small = from_rows(spark, [tuple(r) for r in source.filter("id > 2").collect()], SCHEMA)
    result = upsert(big, small, SPEC).result
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in text and "BroadcastHashJoin" in text
    assert result.count() == 2_000_000


def test_chain_of_operations(spark):
    """Ten thousand rows through insert, upsert, update, sync and delete."""
    n = 10_000
    spec = TableSpec("item", key=("id",), identity="id")

    def batch(ids, label, qty, at):
        return ids.select("id", F.concat(F.lit(label), F.col("id").cast("string")).alias("name"), qty.alias("qty"),
                          (F.col("id") / (F.col("id") % 5 + 1)).alias("price"),
                          F.lit(at).cast("timestamp_ntz").alias("at"))

    empty = spark.createDataFrame([], SCHEMA)
    numbers = spark.range(1, n)
    new = batch(numbers, "name ", (F.col("id") % 10).cast("int"), T0).withColumnRenamed("id", "place")
    inserted = insert_absent(empty, new.withColumn("id", F.lit(0)), spec, ordinal="place").staged()
    assert inserted.stats.first() == (n - 1, 0, 0)
    table = inserted.result
    assert table.filter("concat('name ', id) = name").count() == n - 1
    even = spark.range(2, n + 1, 2)
    changed = batch(even, "name upsert ", (F.col("id") + 100).cast("int"), T0 + dt.timedelta(1))
    upserted = upsert(table, changed, spec, keep_identity=True).staged()
    assert upserted.stats.first() == (1, n // 2 - 1, 0)
    table = upserted.result
    later = batch(even, "name sync ", F.col("id").cast("int"), T0 + dt.timedelta(2))
    synced = sync(table, later, spec, delete_filter="id <> 3", where="s.at > t.at").staged()
    assert synced.stats.first() == (0, n // 2, n // 2 - 1)
    table = synced.result
    assert table.count() == n // 2 + 1
    assert rows(table.filter("id in (2, 3)"), "name") == [("name 3",), ("name sync 2",)]
    kept = sync(table, later.filter("id = 4"), spec, soft_delete={"qty": 0}).result
    assert kept.filter("qty = 0").count() == n // 2
    assert delete(table, later, spec).result.count() == 1
