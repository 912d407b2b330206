"""Row lists, destinations, layouts and progress: what a write does, read back."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Window, functions as F

from .. import insert_absent, upsert
from ..functions import flatten_columns
from ..sources import append, from_rows, truncate
from ..sources.staging import stage_path
from ..spec import TableSpec
from ..streaming import batch_progress
from .registry import Tables, query
from .scenario import CHANGED, COLUMNS, INPUTS, ORDERS, assigned, columns_of, feed, stored

VALUES = COLUMNS[1:]


@query("""SELECT CAST(n_nationkey AS BIGINT) AS key, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '!' ELSE n_name END AS name FROM nation
WHERE n_regionkey <> 2 OR n_nationkey > 10 UNION ALL SELECT n_nationkey + 100, lower(n_name) FROM nation WHERE n_regionkey = 2""")
def source_row_list(tables: Tables):
    """The source is a list of rows that the program holds."""
    nations = [r.asDict() for r in tables.nation.collect()]  # 25 rows at any size
    rows = [{"key": r["n_nationkey"], "name": r["n_name"].upper() + "!"} for r in nations if r["n_regionkey"] == 1]
    rows += [{"key": r["n_nationkey"] + 100, "name": r["n_name"].lower()} for r in nations if r["n_regionkey"] == 2]
    have = tables.nation.filter("n_regionkey <> 2 OR n_nationkey > 10").select(F.col("n_nationkey").cast("bigint").alias("key"), F.col("n_name").alias("name"))
    return upsert(have, from_rows(tables.spark, rows, have.schema), TableSpec("nation", key=("key",))).result


def _new_table(tables: Tables, like) -> tuple[str, str]:
    """An empty table in a folder of its own, as name and path."""
    name, path = f"written_{uuid.uuid4().hex}", stage_path(tables.spark, "written")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    tables.spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet LOCATION '{path}'")
    return name, path


@query(INPUTS + f"""SELECT {assigned('s.o_orderkey IS NOT NULL AND ' + CHANGED, VALUES)} FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey
UNION ALL SELECT {columns_of('s')} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def write_other_destination(tables: Tables):
    """The outcome of a merge goes to another table than the one merged into."""
    merged = upsert(stored(tables), feed(tables), ORDERS).result
    name, path = _new_table(tables, merged)
    append(merged, name)
    tables.spark.sql(f"DROP TABLE {name}")  # the files stay
    return tables.spark.read.schema(merged.schema).parquet(path)


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def write_after_truncate(tables: Tables):
    database = f"written_{uuid.uuid4().hex}"  # a table of its own folder cannot be truncated, one of its own database can
    tables.spark.sql(f"CREATE DATABASE {database} LOCATION '{stage_path(tables.spark, 'written')}'")
    name = f"{database}.orders"
    append(tables.orders.filter("o_orderstatus <> 'F'"), name)
    truncate(tables.spark, name)
    append(tables.orders.filter("o_orderstatus = 'F'"), name)
    return tables.spark.table(name)


def _disorder(rows, group, order, precedes):
    """Rows, and how many follow one in their group that should come after them."""
    along = Window.partitionBy(group).orderBy(order)
    wrong = rows.withColumn("wrong", F.coalesce(precedes(along), F.lit(False)))
    return wrong.agg(F.count(F.lit(1)).alias("n"), F.count_if("wrong").alias("disorder"))


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS disorder FROM lineitem")
def write_sorted(tables: Tables):
    """Each file is laid out by the hint: part rising, quantity falling."""
    name, path = _new_table(tables, tables.lineitem)
    append(tables.lineitem, name, order_hint=["l_partkey", "l_quantity"], descending=["l_quantity"])
    tables.spark.sql(f"DROP TABLE {name}")
    rows = tables.spark.read.parquet(path).select("l_partkey", "l_quantity", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = lambda w: F.lag(F.struct("l_partkey", -F.col("l_quantity"))).over(w) > F.struct("l_partkey", -F.col("l_quantity"))
    return _disorder(rows, "file", "at", before)


@query(INPUTS + f"""SELECT (SELECT count(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey))
  + (SELECT count(*) FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}) AS n, CAST(0 AS BIGINT) AS disorder""")
def merge_output_ordered(tables: Tables):
    """The rows a merge has touched, by rising key over all partitions."""
    rows = upsert(stored(tables), feed(tables), ORDERS).output().select("o_orderkey", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    ends = rows.groupBy("part").agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"), F.count(F.lit(1)).alias("n"), F.max_by("o_orderkey", "at").alias("last"))
    parts = Window.orderBy("part")  # a row per partition
    wrong = (F.lag("high").over(parts) > F.col("low")) | (F.col("last") < F.col("high"))
    return ends.withColumn("wrong", F.coalesce(wrong, F.lit(False))).agg(F.sum("n").alias("n"), F.count_if("wrong").alias("disorder"))


@query("""SELECT c_custkey AS owner_key, c_mktsegment AS segment, n_name AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def owned_table(tables: Tables):
    """A struct that lives in a table of its own is not flattened into its owner but written by the owner's key."""
    profile = F.struct(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))
    nested = tables.customer.join(tables.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_custkey").alias("owner_key"), F.struct("c_name").alias("who"), profile.alias("profile"))
    flat = flatten_columns(nested, keep=["profile"])  # owner_key, who_c_name, profile
    owned = flat.select("owner_key", "profile.*")
    return insert_absent(owned.filter("owner_key % 2 = 0"), owned, TableSpec("profile", key=("owner_key",))).result


@query("SELECT CAST(4 AS BIGINT) AS batches, count(*) AS rows FROM events")
def stream_progress(tables: Tables):
    """What the listener is told of each micro-batch."""
    spark, work, seen = tables.spark, stage_path(tables.spark, "progress"), []
    tables.events.repartition(4, "event_id").write.option("maxRecordsPerFile", 0).parquet(f"{work}/events")
    events = spark.readStream.schema(tables.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/events")
    listener = batch_progress(seen.append)
    spark.streams.addListener(listener)
    try:
        # a plain sink reads each batch once, so that its rows are counted once
        writer = events.writeStream.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True)
        writer.start(f"{work}/copy", format="parquet").awaitTermination()
        until = time.monotonic() + 20
        while sum(p["rows"] > 0 for p in seen) < 4 and time.monotonic() < until:
            time.sleep(0.1)  # the listener is told a little later
    finally:
        spark.streams.removeListener(listener)
    told = from_rows(spark, [{"batch": p["batch"], "rows": p["rows"]} for p in seen if p["rows"]], "batch bigint, rows bigint")
    return told.agg(F.count_distinct("batch").alias("batches"), F.sum("rows").alias("rows"))
