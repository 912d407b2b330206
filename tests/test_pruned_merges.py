"""What a merge or a read may leave alone: equal ranges, rows without a partner, row groups without a key."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_skew import SMALL
from tidemark import TableSpec, batch_delete, batch_update, delete, lookup, merge, sync, table_diff, table_diff_digest, upsert
from tidemark.operators.batch import Aggregate, Lookup, Related
from tidemark.operators.bitmap import in_bitmap, key_bitmap
from tidemark.operators.digests import TableDigests, differing_ranges, digest_columns, digest_table, in_ranges, stretches
from tidemark.operators.intervals import key_intervals, within

ITEMS = TableSpec("items", key=("id",))


@pytest.fixture(scope="module")
def items(spark, tmp_path_factory):
    """20 000 sorted rows in files of many row groups."""
    path = str(tmp_path_factory.mktemp("items") / "sorted")
    df = spark.range(20_000).select("id", (F.col("id") % 7).cast("int").alias("kind"), F.concat(F.lit("name of "), "id").alias("name"))
    df.repartitionByRange(4, "id").sortWithinPartitions("id").write.option("parquet.block.size", 4096).option("parquet.block.row.check.size.min", 100).parquet(path)
    return spark.read.parquet(path)


def rows_read(spark, df, group):
    """Rows that the scans of a job took from their files."""
    spark.sparkContext.setJobGroup(group, group)
    df.write.format("noop").mode("overwrite").save()
    store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(store.lastStageAttempt(s).inputRecords() for s in stages)


# --- digests --------------------------------------------------------------------------


def test_one_changed_row_reads_one_range(spark, items):
    changed = items.withColumn("name", F.when(F.col("id") == 12_345, "other").otherwise(F.col("name")))
    columns = digest_columns(items, ITEMS)
    mine = digest_table(items, ["id"], columns, ranges=100)
    assert 90 <= len(mine.cuts) < 100 and mine.tree.filter("level = 0").agg(F.sum("rows")).first()[0] == 20_000
    assert mine.tree.filter(F.col("level") == mine.levels).count() == 1
    [number] = differing_ranges(mine, digest_table(changed, ["id"], columns, cuts=mine.cuts))
    part = in_ranges(items, mine, [number])
    found = [r["id"] for r in part.collect()]
    assert 12_345 in found and max(found) - min(found) + 1 == len(found) < 2000
    assert "GreaterThanOrEqual(id," in part._jdf.queryExecution().executedPlan().toString()
    assert rows_read(spark, part, "one-range") < 6000
    assert rows(table_diff_digest(items, changed, ITEMS, target_digests=mine)) == [("U", 12_345, 12_345 % 7, "other")]
    assert differing_ranges(mine, digest_table(items.repartition(7), ["id"], columns, cuts=mine.cuts)) == []
    assert table_diff_digest(items, items.repartition(3), ITEMS).count() == 0


def test_stored_digests(spark, items, tmp_path):
    mine = digest_table(items, ["id"], digest_columns(items, ITEMS), ranges=50)
    mine.save(str(tmp_path / "digests"), items)
    loaded = TableDigests.load(spark, str(tmp_path / "digests"), ["id"])
    assert (loaded.cuts, loaded.columns, rows(loaded.tree)) == (mine.cuts, mine.columns, rows(mine.tree))
    source = items.filter("id <> 77 AND id <> 19999").union(spark.createDataFrame([(30_000, 1, "new")], items.schema))
    assert rows(table_diff_digest(items, source, ITEMS, target_digests=loaded)) == rows(table_diff(items, source, ITEMS))


WIDE = "a int, b timestamp, c double, d decimal(12,3), e array<int>, f map<string,int>, g string"


def _wide(seed, n):
    random.seed(seed)
    maybe = lambda v: v if random.random() < 0.8 else None
    keys = [(a, dt.datetime(2024, 1, 1) + dt.timedelta(hours=a * 7 + b, microseconds=b)) for a in range(n) for b in range(3)]
    return [(a, b, maybe(random.choice([1.0, float("nan"), -0.0])), maybe(Decimal(random.randrange(9))), maybe([random.choice([1, None])]),
             maybe({"k": random.randrange(2)}), maybe(random.choice("xy"))) for a, b in keys]


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_digest_diff_is_the_diff(spark, ranges):
    old = _wide(1, 60)
    new = [r if random.random() < 0.9 else n for r, n in zip(old, _wide(2, 60))][20:] + [(500, r[1], *r[2:]) for r in old[:3]]
    spec = TableSpec("wide", key=("a", "b"))
    target, source = (spark.createDataFrame(x, WIDE).repartition(3) for x in (old, new))
    plain, digests = (d.withColumn("f", F.to_json("f")) for d in (table_diff(target, source, spec), table_diff_digest(target, source, spec, ranges)))
    order = lambda d: sorted(map(repr, d.collect()))
    assert order(digests) == order(plain) and len(order(plain)) > 20
    assert order(table_diff_digest(target, source.limit(0), spec, ranges).withColumn("f", F.to_json("f"))) == order(table_diff(target, source.limit(0), spec).withColumn("f", F.to_json("f")))
    assert table_diff_digest(target.limit(0), source, spec, ranges).count() == len(new)


def test_nulls_in_other_columns_differ(spark):
    a, b = (spark.createDataFrame([r], "id int, x int, y int") for r in ((1, None, 5), (1, 5, None)))
    mine = digest_table(a, ["id"], ranges=4)
    assert differing_ranges(mine, digest_table(b, ["id"], cuts=mine.cuts)) == [0]
    with pytest.raises(ValueError, match="other columns"):
        differing_ranges(mine, digest_table(b, ["id"], ["id", "x"], cuts=mine.cuts))


def test_stretches():
    assert stretches([1, 2, 3, 9, 20, 21], 8) == [(1, 3), (9, 9), (20, 21)]
    assert stretches([1, 2, 3, 9, 20, 21], 2) == [(1, 9), (20, 21)] and stretches([4, 9], 1) == [(4, 9)] and stretches([], 3) == []


# --- intervals ------------------------------------------------------------------------


def test_intervals_hold_the_keys_and_little_else(spark, items):
    clusters = [*range(500, 520), *range(7000, 7050), 13_000, *range(19_990, 20_000)]
    asked = spark.createDataFrame([(k,) for k in clusters] + [(None,)], "id long")
    assert key_intervals(asked, "id", 4) == [(500, 519), (7000, 7049), (13_000, 13_000), (19_990, 19_999)]
    assert key_intervals(asked, "id", 2) == [(500, 13_000), (19_990, 19_999)]
    assert key_intervals(asked, "id", 1) == [(500, 19_999)] and key_intervals(asked.limit(0), "id") == []
    found = lookup(asked, items, ITEMS, mode="replace", key_intervals=8)
    assert rows(found, "id") == [(k,) for k in clusters]
    assert "GreaterThanOrEqual(id,500)" in found._jdf.queryExecution().executedPlan().toString()
    part = items.filter(within(F.col("id"), items.schema["id"].dataType, key_intervals(asked, "id", 8)))
    assert rows_read(spark, part, "intervals") < 5000 < rows_read(spark, items, "everything")
    assert rows(delete(items, asked.filter("id IS NOT NULL"), ITEMS, key_intervals=8).changes, "id") == [(k,) for k in clusters]


@pytest.mark.parametrize("kind, values", [
    ("double", [1.0, 1.5, 7e30, float("inf"), float("nan"), -1e300, 0.0]), ("date", [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(1970, 5, 5)]),
    ("timestamp", [dt.datetime(2020, 1, 1, 3), dt.datetime(2024, 1, 1)]), ("decimal(20,4)", [Decimal("1.0001"), Decimal("99999999999.5")]),
    ("string", ["b", "a", "zz"]), ("bigint", [-(1 << 63), (1 << 63) - 1, 0, 5]), ("int", [3])])
def test_no_key_is_outside(spark, kind, values):
    asked = spark.createDataFrame([(v,) for v in values * 2], f"k {kind}")
    for most in (1, 2, 5):
        inside = within(F.col("k"), asked.schema["k"].dataType, key_intervals(asked, "k", most))
        assert asked.filter(inside).count() == 2 * len(values)


def test_gaps_inside_a_narrow_cluster(spark):
    asked = spark.createDataFrame([(k,) for k in [*range(10), *range(900, 910), 10**15]], "k long")
    assert key_intervals(asked, "k", 3) == [(0, 9), (900, 909), (10**15, 10**15)]


# --- bitmap ---------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1 << 15, 1 << 22])
def test_bitmap_divides(spark, bits):
    keys = spark.range(0, 3_000_000, 100)
    table = spark.range(200_000).select("id", F.lit("v").alias("v"))
    held, apart = in_bitmap(table, key_bitmap(keys, ["id"], bits), ["id"], bits)
    inside, outside = held.select("id"), apart.select("id")
    assert inside.intersect(keys.filter("id < 200000")).count() == 2000 and outside.intersect(keys).count() == 0
    n = inside.count()
    assert n + outside.count() == 200_000 and (n > 100_000 if bits == 1 << 15 else n < 4000)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 24])
@pytest.mark.parametrize("operation", ["upsert", "update", "sync", "insert_absent", "changes", "delete"])
def test_bitmap_merge_is_the_merge(spark, operation, bits):
    random.seed(bits)
    row = lambda i: (i if random.random() < 0.95 else None, random.choice([-0.0, 0.0, 1.0]), random.randrange(3))
    target = spark.createDataFrame([row(i) for i in range(400)], "id int, part double, v int").dropDuplicates(["id", "part"])
    source = spark.createDataFrame([row(i) for i in range(300, 600)], "id int, part double, v int").dropDuplicates(["id", "part"])
    if operation == "changes":
        source = source.filter("id IS NOT NULL")
        have = target.select("id", "part").distinct()
        new = source.join(have, ["id", "part"], "left_anti").withColumn("__op", F.lit("I"))
        source = source.join(have, ["id", "part"], "left_semi").withColumn("__op", F.when(F.col("v") == 0, "D").otherwise("U")).unionByName(new)
    spec = TableSpec("t", key=("id", "part"), nullable=frozenset(["id"] if bits > 1 << 20 else []))
    plain, split = (merge(target, source, spec, operation, strategy=s, bitmap_bits=bits) for s in ("outer", "bitmap"))
    assert rows(split.result) == rows(plain.result) and rows(split.changes) == rows(plain.changes) and rows(split.stats) == rows(plain.stats)


def test_bitmap_shuffles_the_matches_only(spark, items):
    source = items.filter("id % 50 = 0").withColumn("name", F.lit("new"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written = {}
        for strategy in ("outer", "bitmap"):
            done = upsert(items, source, ITEMS, strategy=strategy).result
            spark.sparkContext.setJobGroup(strategy, strategy)
            assert done.filter("name = 'new'").count() == 400
            store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
            stages = {s for j in tracker.getJobIdsForGroup(strategy) for s in tracker.getJobInfo(j).stageIds}
            written[strategy] = sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert written["outer"] > 20_000 and written["bitmap"] < 3000


def test_bitmap_with_generated_keys_and_deleted_rows(spark, items):
    spec = TableSpec("items", key=("name",), identity="id")
    source = spark.createDataFrame([(0, 5, "name of 7"), (0, 6, "brand new")], items.schema)
    merged = upsert(items, source, spec, strategy="bitmap").result
    assert rows(merged.filter("kind >= 5 AND (name = 'name of 7' OR name = 'brand new')")) == [(7, 5, "name of 7"), (20_000, 6, "brand new")]
    gone = sync(items, items.filter("id < 19990"), ITEMS, strategy="bitmap", delete_filter="kind <> 2")
    assert rows(gone.changes, "id") == [(i,) for i in range(19_990, 20_000) if i % 7 != 2]


# --- several relations on one key -----------------------------------------------------


def test_many_relations_are_met_at_once(spark):
    random.seed(4)
    before = {k: spark.conf.get(k, None) for k in SMALL}
    target = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50).alias("k"), F.lit(0).alias("v")).repartition(12)
    one = spark.createDataFrame([(i, f"n{i}", {"a": i}) for i in range(40)] + [(None, "null", {})], "ref long, name string, more map<string,int>")
    child = spark.createDataFrame([(random.randrange(50), random.randrange(9)) for _ in range(500)], "p long, x int")
    named = {r["ref"]: (r["name"], r["more"]["a"]) for r in one.collect() if r["ref"] is not None}
    sums = {r["p"]: (r["s"], r["n"]) for r in child.filter("x > 2").groupBy("p").agg(F.sum("x").alias("s"), F.count("x").alias("n")).collect()}
    kids = Aggregate("kids", child, {"k": "p"}, {"s": F.sum("x"), "n": F.count(F.lit(1))}, "x > 2")
    relations = dict(lookups=[Lookup("o", one, {"k": "ref"}), Lookup("u", one, {"k": "ref"}, unique=True)], aggregates=[kids],
                     exists=[Related(child.filter("x < 5"), {"k": "p"})], not_exists=[Related(child.filter("x = 8 AND p % 2 = 0"), {"k": "p"})])
    some, none = ({r["p"] for r in child.filter(t).collect()} for t in ("x < 5", "x = 8 AND p % 2 = 0"))
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        done = batch_update(target, {"v": F.coalesce(F.length("o.name"), F.lit(-1)) + F.col("kids.s") + F.coalesce(F.col("u.more")["a"], F.lit(0))}, "kids.n < 100", **relations).result
        found = {r["id"]: r["v"] for r in done.collect()}
        plan = done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan.split("Initial Plan")[0]
    assert "skew=true" in plan and final.count("SortMergeJoin") == 1
    for r in target.collect():
        k, want = r["k"], 0
        if k in some and k not in none:
            name, a = named.get(k, ("", 0))
            want = (len(name) if name else -1) + sums.get(k, (0, 0))[0] + a
        assert found[r["id"]] == want


def test_relations_that_repeat_a_key_fail(spark):
    t = spark.createDataFrame([(1, 2)], "id int, k int")
    twice = spark.createDataFrame([(2, 1), (2, 3)], "ref int, x int")
    refs = [Lookup("a", twice, {"k": "ref"}), Lookup("b", twice, {"k": "ref"}, unique=True)]
    with pytest.raises(Exception, match="more than one source row"):
        batch_update(t, {"id": F.col("b.x")}, lookups=refs).result.collect()
    assert batch_delete(t, exists=[Related(twice, {"k": "ref"}), Related(twice, {"id": "x"}), Related(twice.filter("x = 3"), {"k": "ref"})]).result.count() == 0
