"""A source read in pages by several tasks; the newest row of a key in a stream's state store."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import QUERIES
from tidemark import TableSpec, upsert
from tidemark.sources import from_pages
from tidemark.sources.pages import PagedSource, _PageReader
from tidemark.sources.staging import staging_root
from tidemark.streaming import StreamedTable, newest_rows, use_state_store

SCHEMA = "id long, name string, at date, price decimal(9,2)"


def _fetch(log, keys):
    """Pages over some keys; each call is noted in a file, with the process that made it."""
    def fetch(low, high, limit):
        import decimal

        with open(log, "a") as out:
            out.write(json.dumps([low, high, limit, os.getpid()]) + "\n")
        found = [(k, f"n{k}" if k % 4 else None, dt.date(2024, 1, 1 + k % 28), decimal.Decimal(k) / 4) for k in keys if low <= k <= high]
        return found[:limit]

    return fetch


def _calls(log):
    with open(log) as lines:
        return [json.loads(line) for line in lines]


def test_every_page_once(spark, tmp_path):
    log, keys = str(tmp_path / "log"), [*range(0, 500, 3), 700, 701]
    df = from_pages(spark, SCHEMA, "id", _fetch(log, keys), 0, 1000, partitions=5, page=20)
    assert df.rdd.getNumPartitions() == 5
    assert rows(df, "id") == [(k,) for k in keys] and df.filter("name IS NULL").count() == sum(k % 4 == 0 for k in keys)
    first = _calls(log)
    assert {c[0] for c in first} >= {0, 200, 400, 600, 800} and all(c[2] == 20 for c in first)


def test_filters_narrow_the_range(spark, tmp_path):
    log = str(tmp_path / "log")
    df = from_pages(spark, SCHEMA, "id", _fetch(log, range(1000)), 0, 999, partitions=4, page=50)
    assert rows(df.filter("id >= 300 AND id < 340 AND name <> 'n301'"), "id") == [(k,) for k in range(300, 340) if k % 4 and k != 301]
    assert min(c[0] for c in _calls(log)) == 300 and max(c[1] for c in _calls(log)) == 339
    assert df.filter("id = 7").count() == 1 and df.filter("id > 2000").count() == 0 and df.filter("id IN (1, 5)").count() == 2


def test_keys_that_repeat_across_pages(spark, tmp_path):
    keys = sorted([1] * 7 + [2] * 70 + [3] + [9] * 5)
    df = from_pages(spark, SCHEMA, "id", _fetch(str(tmp_path / "log"), keys), 0, 10, partitions=2, page=6)
    assert {r["id"]: r["n"] for r in df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()} == {1: 7, 2: 70, 3: 1, 9: 5}


def test_parts_and_refusals(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    reader = _PageReader(PagedSource(schema, "id", None, 5, 7, partitions=8))
    assert [(p.low, p.high) for p in reader.partitions()] == [(5, 5), (6, 6), (7, 7)]
    with pytest.raises(ValueError, match="no column"):
        from_pages(spark, SCHEMA, "key", None, 0, 1)


def test_a_merge_reads_pages(spark, tmp_path):
    pages = from_pages(spark, SCHEMA, "id", _fetch(str(tmp_path / "log"), range(50)), 0, 49, partitions=3, page=7)
    target = spark.createDataFrame([(3, "old", None, None), (99, "stays", None, None)], SCHEMA)
    merged = upsert(target, pages, TableSpec("t", key=("id",)))
    assert merged.stats.first().asDict() == {"inserted": 49, "updated": 1, "deleted": 0}


# --- state ----------------------------------------------------------------------------

EVENTS = "k string, at timestamp, seq int, v double"


def _write(spark, folder, name, data):
    spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def _run(spark, table, folder, checkpoint, passed):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")

    def each(batch, number):
        batch = batch.persist()
        passed.append(rows(batch, "k", "seq"))
        table.apply(batch, number)

    newest = newest_rows(stream, ["k"], ["at", "seq"])
    newest.writeStream.option("checkpointLocation", checkpoint).outputMode("update").foreachBatch(each).trigger(availableNow=True).start().awaitTermination()


def test_winners_alone_reach_the_table_also_after_a_restart(spark, tmp_path):
    use_state_store(spark)
    t = lambda s: dt.datetime(2024, 5, 1) + dt.timedelta(seconds=s)
    folder, passed = str(tmp_path / "in"), []
    table = StreamedTable(str(tmp_path / "table"), TableSpec("t", key=("k",)), EVENTS, ["at", "seq"], newer_by="at", buckets=4)
    _write(spark, folder, "a", [("x", t(10), 1, 1.0), ("x", t(10), 2, 2.0), ("y", t(5), 1, 3.0), (None, t(1), 1, 9.0), ("z", None, 1, 0.0)])
    _write(spark, folder, "b", [("x", t(9), 9, 4.0), ("y", t(6), 1, None), ("y", t(5), 8, 6.0)])
    _run(spark, table, folder, str(tmp_path / "check"), passed)
    assert sorted(passed) == sorted([[("x", 2), ("y", 1), (None, 1)], [("y", 1)]]) and len(passed) == 2
    passed.clear()  # a new query over the same checkpoint knows what has passed
    _write(spark, folder, "c", [("x", t(10), 2, 7.0), ("x", t(10), 1, 8.0), ("y", t(7), 1, 5.0), ("w", t(0), 1, 1.0)])
    _run(spark, table, folder, str(tmp_path / "check"), passed)
    assert passed == [[("w", 1), ("y", 1)]]
    assert rows(table.read(spark), "k", "v") == [("w", 1.0), ("x", 2.0), ("y", 5.0), (None, 9.0)]


def test_a_table_with_more_buckets_goes_on(spark, tmp_path):
    t = lambda s: dt.datetime(2024, 5, 1) + dt.timedelta(seconds=s)
    make = lambda data: spark.createDataFrame(data, EVENTS)
    table = StreamedTable(str(tmp_path / "few"), TableSpec("t", key=("k",)), EVENTS, ["at", "seq"], newer_by="at", buckets=2)
    table.apply(make([(f"k{i}", t(i), 1, float(i)) for i in range(40)]), 0)
    grown = table.rebucketed(spark, str(tmp_path / "more"), 16)
    assert rows(grown.read(spark)) == rows(table.read(spark)) and len(os.listdir(tmp_path / "more")) > 8
    grown.apply(make([("k3", t(99), 1, -1.0), ("k4", t(0), 1, -1.0), ("new", t(1), 1, 0.5)]), 1)
    found = {r["k"]: r["v"] for r in grown.read(spark).collect()}
    assert len(found) == 41 and (found["k3"], found["k4"], found["new"]) == (-1.0, 4.0, 0.5) and table.read(spark).count() == 40


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="no columns q"):
        newest_rows(spark.createDataFrame([], EVENTS), ["k"], ["q"])


def test_a_batch_is_evaluated_once(spark, tmp_path):
    """What comes out of a state store must not be worked out again for each reader of the batch."""
    seen = spark.sparkContext.accumulator(0)
    table = StreamedTable(str(tmp_path / "table"), TableSpec("t", key=("k",)), EVENTS, ["at", "seq"], newer_by="at", buckets=4)
    data = [(f"k{i}", dt.datetime(2024, 5, 1), 1, float(i)) for i in range(20)]
    batch = spark.createDataFrame(data, EVENTS).mapInPandas(lambda frames: (f for f in frames if not seen.add(len(f))), EVENTS)
    table.apply(batch, 0)
    assert seen.value == 20 and table.read(spark).count() == 20


def test_parts_of_many_files_are_batches_all_the_same(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 60)
    try:
        assert QUERIES["stream_state_newer_wins"](spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    commits = glob.glob(f"{staging_root(spark)}/{spark.sparkContext.applicationId}/stream-*/checkpoint/commits/[0-9]*")
    assert sorted(os.path.basename(c) for c in commits) == ["0", "1", "2", "3"]
