import datetime as dt
from decimal import Decimal
from uuid import UUID

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import Aggregate, Lookup, TableSpec, batch_delete, batch_update, cascade_delete, lookup
from tidemark.operators.batch import Related, changed_values, child_value

@pytest.fixture(scope="module")
def table(spark):
    """A thousand readings of ten sensors."""
    return spark.range(1, 1001).select(
        F.col("id").cast("int"), F.format_string("probe %d", "id").alias("name"), F.lit("calm").alias("state"),
        (F.col("id") % 10).cast("int").alias("sensor"), (F.col("id") / (F.col("id") % 5 + 1)).alias("depth"))


def test_updates_see_the_old_row(table):
    stormy = batch_update(table, changed_values({"state": "stormy", "depth": 0.75, "sensor": 0}), "sensor = 3 AND depth > 10").result
    assert stormy.filter("state = 'stormy' AND depth = 0.75 AND sensor = 3").count() == table.filter("sensor = 3 AND depth > 10").count() > 0
    swapped = batch_update(table, {"sensor": lambda t: t.id, "id": lambda t: t.sensor - 1}, "id BETWEEN 20 AND 22").result
    assert rows(swapped.filter("sensor BETWEEN 20 AND 22"), "id", "sensor") == [(-1, 20), (0, 21), (1, 22)]
    one = batch_update(table, {"name": "deepest"}, "sensor <> 9", key=["id"], order_by=[F.col("depth").desc()], limit=1)
    assert one.affected_count.first()[0] == 1 and rows(one.affected, "id") == [(1000,)]
    gone = batch_delete(table, "depth < 2")
    assert gone.affected_count.first()[0] + gone.result.count() == 1000 and gone.result.filter("depth < 2").count() == 0


def test_null_predicates_affect_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert rows(batch_delete(df, "v < 10").result) == [(1, None)]
    assert rows(batch_update(df, {"v": 0}, lambda t: t.v < 10).result) == [(1, None), (2, 0)]
    assert batch_delete(df, F.col("v").isin([])).result.count() == 2


def test_values():
    assert changed_values({"a": 0, "b": "", "c": None, "d": 5}) == {"b": "", "d": 5}
    unset = {"n": Decimal(0), "u": UUID(int=0), "t": dt.time(0, 0), "d": dt.date(1, 1, 1), "s": dt.datetime(1, 1, 1)}
    assert changed_values(unset | {"at": dt.datetime(1, 1, 1, 5)}) == {"at": dt.datetime(1, 1, 1, 5)}
    assert changed_values({"a": 0, "c": None}, ["a", "c"]) == {"a": 0, "c": None}
    with pytest.raises(ValueError, match="nothing to set"):
        changed_values({"a": 0, "b": False})
    with pytest.raises(ValueError, match="without a value: z"):
        changed_values({"a": 1}, ["z"])


def test_update_checks(table):
    with pytest.raises(ValueError, match="unknown columns: nope"):
        batch_update(table, {"nope": 1})
    with pytest.raises(ValueError, match="nothing to set"):
        batch_update(table, {})
    with pytest.raises(ValueError, match="need order_by"):
        batch_delete(table, limit=3)


def test_skip_and_take(table):
    kept = batch_delete(table, key=["id"], order_by=["name"], offset=2, limit=4).result
    names = sorted(f"probe {i}" for i in range(1, 1001))
    assert set(rows(kept, "name")) == {(n,) for n in names[:2] + names[6:]}
    assert batch_delete(table, key=["id"], order_by=["name"], offset=990).result.count() == 990


def test_related_tables(spark):
    wells = spark.createDataFrame([(11, "dry", 1.0), (12, "dry", 2.0), (13, "dry", 4.0)], "well int, state string, flow double")
    logs = spark.createDataFrame([(11, "gravel"), (12, None)], "of_well int, layer string")
    pumps = spark.createDataFrame([(11, "on", 2.5), (11, "on", 0.5), (11, "off", 40.0), (12, "off", 8.0)], "at_well int, mode string, litres double")
    log = Lookup("log", logs, {"well": "of_well"})
    filled = batch_update(wells, {"state": F.coalesce(F.col("log.layer"), F.lit("unlogged"))}, "well < 99", lookups=[log])
    assert rows(filled.result, "well", "state") == [(11, "gravel"), (12, "unlogged"), (13, "unlogged")]
    assert rows(batch_update(wells, {"state": "known"}, "t.well < 99 AND log.layer > ''", lookups=[log]).affected, "well") == [(11,)]
    running = Aggregate("p", pumps, {"well": "at_well"}, {"litres": F.sum("litres"), "n": F.count(F.lit(1))}, "mode = 'on'")
    summed = batch_update(wells, {"flow": child_value(running, "litres"), "state": child_value(running, "n").cast("string")}, aggregates=[running])
    assert rows(summed.result) == [(11, "2", 3.0), (12, "0", 0.0), (13, "0", 0.0)]
    assert rows(batch_delete(wells, not_exists=[Related(pumps, {"well": "at_well"})]).affected, "well") == [(13,)]
    assert rows(cascade_delete(pumps, wells.filter("well = 11"), {"at_well": "well"}), "at_well") == [(12,)]
    twice = Lookup("log", logs.union(logs), {"well": "of_well"})
    with pytest.raises(PySparkException, match="more than one source row"):
        batch_update(wells, {"state": F.col("log.layer")}, lookups=[twice]).result.collect()


def test_predicates_see_empty_aggregates(spark):
    wells = spark.createDataFrame([(1, "a"), (2, "b")], "well int, state string")
    pumps = spark.createDataFrame([(1, "x", 5)], "at_well int, kind string, n int")
    of = Aggregate("p", pumps, {"well": "at_well"}, {"n": F.sum("n"), "kind": F.max("kind")})
    assert rows(batch_delete(wells, "p.n = 0", aggregates=[of]).affected, "well") == [(2,)]
    assert rows(batch_update(wells, {"state": child_value(of, "kind")}, aggregates=[of]).result) == [(1, "x"), (2, None)]
    named = Aggregate("p", pumps, {"well": "at_well"}, {"kind": F.max("kind")}, empty="none")
    assert rows(batch_update(wells, {"state": child_value(named, "kind")}, aggregates=[named]).result) == [(1, "x"), (2, "none")]
    with pytest.raises(ValueError, match="named like columns of the target: state"):
        batch_delete(wells, aggregates=[Aggregate("state", pumps, {"well": "at_well"}, {"n": F.sum("n")})]).result


def test_building_a_plan_runs_no_job(spark):
    wells = spark.createDataFrame([(1, "a")], "well int, state string")
    refs = [Lookup(f"l{i}", wells.withColumnRenamed("well", f"w{i}"), {"well": f"w{i}"}) for i in range(3)]
    spark.sparkContext.setJobGroup("building", "")
    try:
        done = batch_update(wells, {"state": F.col("l2.state")}, lookups=refs)
        done.result, done.affected_count, lookup(wells, wells, TableSpec("n", key=("state",)), mode="replace")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_key_asked_for_very_often_is_spread(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    asked = spark.range(300_000).select(F.lit("a").alias("name")).union(spark.createDataFrame([("b",)], "name string"))
    found = lookup(asked, known, TableSpec("n", key=("name",)), mode="replace")
    assert rows(found.groupBy("name").count()) == [("a", 300_000), ("b", 1)]
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 2


SPEC = TableSpec("item", key=("id",))


def test_enrich_keeps_every_source_row(spark, table):
    asked = spark.createDataFrame([("probe 5", 1), ("nobody", 2), ("probe 5", 3)], "name string, place int")
    found = lookup(asked, table, SPEC, match_on=["name"], columns=["id", "sensor"])
    assert rows(found, "place", "name", "id", "sensor") == [(1, "probe 5", 5, 5), (2, "nobody", None, None), (3, "probe 5", 5, 5)]


def test_first_match_needs_an_order(spark, table):
    asked = spark.createDataFrame([("calm", 0)], "state string, sensor int")
    assert rows(lookup(asked, table, SPEC, match_on=["state"], first_by=["id"]), "id", "sensor") == [(1, 1)]
    with pytest.raises(PySparkException, match="more than one source row"):
        lookup(asked, table, SPEC, match_on=["state"]).collect()


def test_replace(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "id int, name string")
    asked = spark.createDataFrame([("a",), ("b",), ("none",), ("b",)], "name string")
    spec = TableSpec("n", key=("id",))
    assert rows(lookup(asked, t, spec, mode="replace", match_on=["name"])) == [(1, "a"), (2, "b"), (2, "b"), (3, "b"), (3, "b")]
    assert rows(lookup(asked, t, spec, mode="replace", match_on=["name"], duplicates="drop")) == [(1, "a"), (2, "b"), (3, "b")]
    often = spark.range(10_000).select(F.lit("a").alias("name"))
    assert lookup(often, t, spec, mode="replace", match_on=["name"]).count() == 10_000


def test_lookup_checks(table):
    for bad, message in [(dict(mode="x"), "mode"), (dict(match_on=["x"]), "unknown columns: x"),
                         (dict(mode="replace", duplicates="x"), "duplicates")]:
        with pytest.raises(ValueError, match=message):
            lookup(table, table, SPEC, **bad)
    with pytest.raises(ValueError, match="needs a key"):
        lookup(table, table, TableSpec("n"))


def test_keys_are_not_glued_together(spark):
    t = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 2)], "x string, y string, v int")
    asked = spark.createDataFrame([("a", "b_c"), ("a_b", "c")], "x string, y string")
    assert rows(lookup(asked, t, TableSpec("p", key=("x", "y")))) == [("a", "b_c", 2), ("a_b", "c", 1)]


def test_united_relations_are_shuffled_before_they_are_combined(spark):
    """Each relation holds a key once by then; to combine before the shuffle would hold all keys in a task's memory."""
    many = spark.range(100).select((F.col("id") % 10).alias("of"), F.col("id").alias("v"))
    sums = Aggregate("sums", many, {"k": "of"}, {"total": F.sum("v")})
    counts = Aggregate("counts", many, {"k": "of"}, {"n": F.count(F.lit(1))}, "v > 50")
    table = spark.range(12).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("a"))
    done = batch_update(table, {"a": child_value(sums, "total") + child_value(counts, "n")}, aggregates=[sums, counts]).result
    plan = done._jdf.queryExecution().executedPlan().toString().splitlines()
    above = [line for line in plan[:next(i for i, line in enumerate(plan) if "Union" in line)] if "Project" not in line]
    assert "Exchange" in above[-1]
    assert rows(done, "k", "a") == sorted((k, sum(range(k, 100, 10)) + sum(v > 50 for v in range(k, 100, 10)) if k < 10 else 0) for k in range(12))
