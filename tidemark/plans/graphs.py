"""Nested rows into related tables, change sets over several tables, and a streamed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import ForeignKey, Many, Node, One, apply_changes, fill_self_reference, flatten_graph, merge_graph
from ..operators import ancestry, cascade_delete_tree
from ..operators.graph import graph_stats as summed_stats, unique_rows
from ..operators.skew import join_many_to_one, met_by_sort
from ..sources.staging import stage_path
from ..spec import TableSpec
from ..streaming import StreamedTable, newest_rows, use_state_store
from .registry import Tables, query
from .scenario import COLUMNS, INPUTS, feed, stored

# Each line holds its order, each order its customer: many nested copies of the same parent.
CUSTOMER = Node(TableSpec("customer", key=("c_custkey",)))
ORDER = Node(TableSpec("orders", key=("o_orderkey",)), one=(One("customer", CUSTOMER, "o_custkey"),))
LINE = Node(TableSpec("lineitem", key=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
            one=(One("order", ORDER, "l_orderkey"),))


def _nested_lines(tables: Tables):
    customer = F.struct("s.c_custkey", "s.c_name", "s.c_mktsegment").alias("customer")
    orders = join_many_to_one(tables.orders, tables.customer, ["o_custkey"], ["c_custkey"], "inner").select(
        "t.o_orderkey", "t.o_totalprice", customer)
    lines = tables.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    order = F.struct("s.o_orderkey", "s.o_totalprice", "s.customer").alias("order")
    return join_many_to_one(lines, orders, ["l_orderkey"], ["o_orderkey"], "inner").select(
        *[F.col(f"t.{c}") for c in lines.columns], order)


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def graph_flatten_lines(tables: Tables):
    return flatten_graph(_nested_lines(tables), LINE)["lineitem"].rows.drop("__row")


@query("SELECT o_orderkey, o_totalprice, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def graph_flatten_orders(tables: Tables):
    return unique_rows(flatten_graph(_nested_lines(tables), LINE)["orders"].rows, ORDER).drop("__row")


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN
          (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""")
def graph_dedupe(tables: Tables):
    """The first nested instance of each customer."""
    return unique_rows(flatten_graph(_nested_lines(tables), LINE)["customer"].rows, CUSTOMER).drop("__row")


# Orders with generated numbers and, as nested rows, their due dates.
DUE = Node(TableSpec("due", key=("order_id", "what")))
SHEET = Node(TableSpec("sheet", key=("id",), identity="id"), many=(Many("dates", DUE, "order_id"),))
SHEET_IDS = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id, o_custkey, o_orderdate FROM orders"


def _sheets(tables: Tables, about: str = "o_custkey"):
    date = F.col("o_orderdate")
    dates = F.array(
        F.struct(F.lit("ship").alias("what"), (date + F.expr("INTERVAL 7 DAY")).alias("at")),
        F.struct(F.lit("pay").alias("what"), (date + F.expr("INTERVAL 30 DAY")).alias("at")),
    )
    return tables.orders.select("o_orderkey", about, dates.alias("dates"))


def _merge_sheets(tables: Tables):
    empty = {
        "sheet": tables.spark.createDataFrame([], "id bigint, o_orderkey bigint, o_custkey bigint"),
        "due": tables.spark.createDataFrame([], "order_id bigint, what string, at timestamp_ntz"),
    }
    return merge_graph(_sheets(tables), SHEET, empty, "upsert", ordinal="o_orderkey")


@query(f"""SELECT id AS order_id, 'ship' AS what, o_orderdate + INTERVAL 7 DAY AS "at" FROM ({SHEET_IDS})
UNION ALL SELECT id, 'pay', o_orderdate + INTERVAL 30 DAY FROM ({SHEET_IDS})""")
def graph_fk_propagation(tables: Tables):
    """Children carry the numbers generated for their parents."""
    return _merge_sheets(tables)["due"].result


@query(f"SELECT id, o_orderkey, o_custkey FROM ({SHEET_IDS})")
def graph_generated_parents(tables: Tables):
    return _merge_sheets(tables)["sheet"].result


@query("SELECT CAST(3 * count(*) AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted FROM orders")
def graph_stats(tables: Tables):
    return summed_stats(_merge_sheets(tables))


# Customers found by name, each holding orders; some customers are in the table already.
BUYER = Node(TableSpec("buyer", key=("id",), identity="id"), match_on=("c_name",))
PURCHASE = Node(TableSpec("purchase", key=("o_orderkey",)), one=(One("buyer", BUYER, "buyer_id"),))


SHARED = """
WITH known AS (SELECT c_custkey AS id, c_name FROM customer WHERE c_acctbal >= 0),
 seen AS (SELECT c.c_name, min(o.o_orderkey) AS first FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1),
 ids AS (SELECT c_name, id FROM known UNION ALL
         SELECT c_name, (SELECT max(id) FROM known) + row_number() OVER (ORDER BY first)
         FROM seen WHERE c_name NOT IN (SELECT c_name FROM known))
SELECT o.o_orderkey, o.o_totalprice, ids.id AS buyer_id
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN ids ON ids.c_name = c.c_name"""


@query(SHARED)
def graph_shared_parent(tables: Tables):
    """Orders refer to buyers by nested copies; a buyer new to the table gets one number for all of them."""
    return _purchases(tables, "upsert")


@query(SHARED)
def graph_absent_parents(tables: Tables):
    """Buyers that are there already are left alone, and hand their numbers down all the same."""
    return _purchases(tables, "insert_absent")


def _purchases(tables: Tables, operation: str):
    nested = join_many_to_one(tables.orders, tables.customer, ["o_custkey"], ["c_custkey"], "inner").select(
        "t.o_orderkey", "t.o_totalprice", F.struct("s.c_name").alias("buyer"))
    targets = {
        "buyer": tables.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), "c_name"),
        "purchase": tables.spark.createDataFrame([], "o_orderkey bigint, o_totalprice double, buyer_id bigint"),
    }
    return merge_graph(nested, PURCHASE, targets, operation, ordinal="o_orderkey")["purchase"].result


def _dues(tables: Tables, ordinal: str | None):
    """Each order's due dates, found through the number generated for it."""
    empty = {
        "sheet": tables.spark.createDataFrame([], "id bigint, o_orderkey bigint, o_orderpriority string"),
        "due": tables.spark.createDataFrame([], "order_id bigint, what string, at timestamp_ntz"),
    }
    results = merge_graph(_sheets(tables, "o_orderpriority"), SHEET, empty, "upsert", ordinal=ordinal)
    sheets = met_by_sort(results["sheet"].staged().result)
    return join_many_to_one(results["due"].result, sheets, ["order_id"], ["id"], "inner").select("s.o_orderkey", "t.what", "t.at")


DUES = """SELECT o_orderkey, 'ship' AS what, o_orderdate + INTERVAL 7 DAY AS "at" FROM orders
UNION ALL SELECT o_orderkey, 'pay', o_orderdate + INTERVAL 30 DAY FROM orders"""


@query(DUES)
def graph_repeated_ordinal(tables: Tables):
    """Orders in the order of their priority, a text that thousands share."""
    return _dues(tables, "o_orderpriority")


@query(DUES)
def graph_without_ordinal(tables: Tables):
    return _dues(tables, None)


@query("SELECT l_partkey AS part, l_orderkey AS of_order, l_linenumber AS of_line, l_suppkey AS of_supplier, l_quantity AS n FROM lineitem")
def graph_composite_parent(tables: Tables):
    """Children take all columns of their parent's key."""
    part = Node(TableSpec("part", key=("part",)))
    line = Node(TableSpec("line", key=("o", "l", "s")), many=(Many("parts", part, ("of_order", "of_line", "of_supplier")),))
    parts = F.array(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("n")))
    nested = tables.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.col("l_suppkey").alias("s"), parts.alias("parts"))
    return flatten_graph(nested, line)["part"].rows.drop("__row")


@query("""SELECT count(DISTINCT CASE WHEN c_acctbal >= 0 THEN c_name END) + count(CASE WHEN c_acctbal < 0 THEN 1 END) AS buyers,
  count(*) AS purchases FROM orders JOIN customer ON c_custkey = o_custkey""")
def graph_null_natural_key(tables: Tables):
    """Buyers without a name are not one buyer: each of their orders has its own."""
    name = F.when(F.col("s.c_acctbal") >= 0, F.col("s.c_name"))
    nested = join_many_to_one(tables.orders, tables.customer, ["o_custkey"], ["c_custkey"], "inner").select("t.o_orderkey", F.struct(name.alias("c_name")).alias("buyer"))
    targets = {"buyer": tables.spark.createDataFrame([], "id bigint, c_name string"),
               "purchase": tables.spark.createDataFrame([], "o_orderkey bigint, buyer_id bigint")}
    done = merge_graph(nested, PURCHASE, targets, "upsert", ordinal="o_orderkey")["purchase"].result
    return done.agg(F.count_distinct("buyer_id").alias("buyers"), F.count(F.lit(1)).alias("purchases"))


@query("""SELECT c.c_name, c.c_custkey + 1000 AS id, p.c_custkey + 1000 AS referrer_id FROM customer c
LEFT JOIN customer p ON p.c_name = 'Customer#' || lpad(CAST(c.c_nationkey AS VARCHAR), 9, '0')""")
def graph_self_reference(tables: Tables):
    rows = tables.customer.select(
        "c_name", (F.col("c_custkey") + 1000).alias("id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("c_nationkey").cast("string"), 9, "0")).alias("referrer"))
    return fill_self_reference(rows, "id", ["c_name"], ["referrer"], "referrer_id").drop("referrer")


@query("""
WITH c AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name, c_custkey + 1000 AS id, 'Customer#' || lpad(CAST(c_nationkey AS VARCHAR), 9, '0') AS referrer FROM customer)
SELECT c.c_name, c.id, p.id AS referrer_id FROM c LEFT JOIN c p ON p.c_name = c.referrer""")
def graph_self_reference_nulls(tables: Tables):
    """A third of the names is missing: nobody refers to those rows, and they are not gathered."""
    rows = tables.customer.select(
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("c_name"), (F.col("c_custkey") + 1000).alias("id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("c_nationkey").cast("string"), 9, "0")).alias("referrer"))
    return fill_self_reference(rows, "id", ["c_name"], ["referrer"], "referrer_id").drop("referrer")


@query("""
WITH RECURSIVE tree AS (SELECT c_custkey, CASE WHEN c_custkey % 400 >= 3 THEN c_custkey - 3 END AS parent FROM customer),
gone AS (
  SELECT c_custkey FROM customer WHERE c_acctbal < -900 UNION SELECT t.c_custkey FROM tree t JOIN gone g ON t.parent = g.c_custkey)
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone)""", name="cascade_delete_tree")
def cascade_delete_below(tables: Tables):
    """Customers recruited by one another in long chains: who is deleted takes all below along."""
    tree = tables.customer.withColumn("parent", F.when(F.col("c_custkey") % 400 >= 3, F.col("c_custkey") - 3))
    return cascade_delete_tree(tree, "c_custkey", "parent", tables.customer.filter("c_acctbal < -900")).drop("parent")


@query("""
WITH RECURSIVE up AS (
  SELECT c_custkey AS k, c_custkey AS a, 0 AS n FROM customer
  UNION ALL SELECT up.k, c.c_custkey, up.n + 1 FROM up JOIN customer c ON c.c_custkey = up.a - 3 WHERE up.a % 400 >= 3)
SELECT k AS c_custkey, min(a) AS root, CAST(max(n) AS BIGINT) AS depth FROM up GROUP BY k""")
def ancestry_of_chains(tables: Tables):
    """The topmost ancestor of each row and its distance, in rounds that grow with the logarithm of the depth."""
    tree = tables.customer.withColumn("parent", F.when(F.col("c_custkey") % 400 >= 3, F.col("c_custkey") - 3))
    return ancestry(tree, "c_custkey", "parent").drop("marked")


@query("""SELECT d.doc_id, u.line FROM documents d, unnest(string_split(d.text, chr(10))) AS u(line)""")
def graph_document_lines(tables: Tables):
    """A document's lines as child rows, from the whole text."""
    line = Node(TableSpec("line", key=("doc_id",)))
    document = Node(TableSpec("document", key=("doc_id",)), many=(Many("lines", line, "doc_id"),))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line")))
    nested = tables.documents.select("doc_id", lines.alias("lines"))
    return flatten_graph(nested, document)["line"].rows.drop("__row")


# --- change sets ----------------------------------------------------------------------


@query("""
WITH ids AS (SELECT conv_id, 1000 + row_number() OVER (ORDER BY conv_id) AS id FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT ids.id AS talk_id, c.turn, c.role, c.text FROM conversations c JOIN ids ON ids.conv_id = c.conv_id""")
def apply_changes_insert(tables: Tables):
    """New talks get numbers after 1000; their turns are inserted with those numbers."""
    talks = tables.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")).select(
        F.lit(None).cast("bigint").alias("id"), "turns", "conv_id", F.lit("I").alias("op"))
    turns = tables.conversations.select(F.col("conv_id").alias("talk"), F.lit(None).cast("bigint").alias("talk_id"),
                                        "turn", "role", "text", F.lit("I").alias("op"))
    spark = tables.spark
    targets = {"turn": spark.createDataFrame([], "talk_id bigint, turn bigint, role string, text string"),
               "talk": spark.createDataFrame([(1000, 0)], "id bigint, turns bigint")}
    specs = {"talk": TableSpec("talk", key=("id",), identity="id"), "turn": TableSpec("turn", key=("talk_id", "turn"))}
    keyed = [ForeignKey("turn", "talk_id", "talk", reference="talk")]
    # the talks' ordinal is their conversation; turns have no generated key and need none
    results = apply_changes(targets, {"turn": turns, "talk": talks}, specs, keyed, ordinal={"talk": "conv_id"})
    return results["turn"].result


@query("""
WITH t AS (SELECT conv_id, turn, CAST(row_number() OVER (ORDER BY conv_id, turn) AS BIGINT) AS turn_id FROM conversations WHERE turn IS NOT NULL),
c AS (SELECT conv_id, CAST(500 + row_number() OVER (ORDER BY conv_id) AS BIGINT) AS talk_id, arg_min(turn_id, turn) AS opened_by FROM t GROUP BY conv_id)
SELECT 'talk' AS kind, talk_id AS id, opened_by AS refers_to FROM c
UNION ALL SELECT 'turn', turn_id, talk_id FROM t JOIN c ON c.conv_id = t.conv_id""")
def apply_changes_circle(tables: Tables):
    """A talk names its opening turn, a turn its talk; both keys are generated."""
    place = F.col("conv_id") * 1_000_000 + F.col("turn")
    said = tables.conversations.filter("turn IS NOT NULL")
    turns = said.select(place.alias("place"), F.col("conv_id").alias("talk"), F.lit("I").alias("op"), F.lit(None).cast("bigint").alias("id"))
    talks = said.groupBy("conv_id").agg(F.min(place).alias("opening")).select(
        "conv_id", "opening", F.lit("I").alias("op"), F.lit(None).cast("bigint").alias("id"))
    targets = {"talk": tables.spark.createDataFrame([], "id bigint, opened_by bigint"), "turn": tables.spark.createDataFrame([], "id bigint, talk_id bigint")}
    targets["talk"] = targets["talk"].union(tables.spark.createDataFrame([(500, None)], targets["talk"].schema))
    specs = {n: TableSpec(n, key=("id",), identity="id") for n in targets}
    keyed = [ForeignKey("talk", "opened_by", "turn", reference="opening"), ForeignKey("turn", "talk_id", "talk", reference="talk")]
    done = apply_changes(targets, {"talk": talks, "turn": turns}, specs, keyed, ordinal={"talk": "conv_id", "turn": "place"})
    new = done["talk"].result.filter("id > 500").select(F.lit("talk").alias("kind"), "id", F.col("opened_by").alias("refers_to"))
    return new.union(done["turn"].result.select(F.lit("turn"), "id", "talk_id"))


@query(INPUTS + f"""
SELECT {', '.join('coalesce(s.' + c + ', t.' + c + ') AS ' + c for c in COLUMNS)}
FROM t FULL JOIN (SELECT * FROM s WHERE (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') OR o_orderpriority = '3-MEDIUM') s
  ON s.o_orderkey = t.o_orderkey
WHERE NOT (coalesce(t.o_orderpriority, '') = '4-NOT SPECIFIED' AND coalesce(t.o_orderstatus, '') = 'F')""")
def apply_changes_mixed(tables: Tables):
    """Open urgent orders arrive, medium ones change, finished unspecified ones go; the rest is not mentioned."""
    return _mixed(tables)["orders"].result


def _mixed(tables: Tables):
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    op = (
        F.when(urgent, "I").when(F.col("o_orderpriority") == "3-MEDIUM", "U")
        .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"), "D")
    )
    changes = feed(tables).withColumn("op", op).filter("op IS NOT NULL")
    return apply_changes({"orders": stored(tables)}, {"orders": changes},
                         {"orders": TableSpec("orders", key=("o_orderkey",))})


@query("""SELECT (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') AS inserted,
  (SELECT count(*) FROM orders WHERE o_orderpriority = '3-MEDIUM') AS updated,
  (SELECT count(*) FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F') AS deleted""")
def apply_changes_stats(tables: Tables):
    return summed_stats(_mixed(tables))


# --- streams --------------------------------------------------------------------------

LATEST = """SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events {where}) WHERE rn = 1"""


def _streamed(tables: Tables, newer_by: str | None, state: bool = False):
    """Events in four batches by their time: the latest last, or first if late rows must lose."""
    spark = tables.spark
    schema = "user_id bigint, event_id bigint, ts timestamp_ntz, event_type string, value double"
    work = stage_path(spark, "stream")
    table = StreamedTable(f"{work}/table", TableSpec("last_event", key=("user_id",)), schema, ["ts", "event_id"],
                          newer_by=newer_by, buckets=8)
    first, last = tables.events.agg(F.min("ts"), F.max("ts")).first()
    if state:
        use_state_store(spark)
    for i in range(3, -1, -1) if newer_by else range(4):
        low, high = (F.lit(first + (last - first) * n / 4) for n in (i, i + 1))
        part = (F.col("ts") >= low) & ((F.col("ts") < high) if i < 3 else F.lit(True))
        tables.events.filter(part).write.parquet(f"{work}/events/{i}")
        # the stream goes on with what has come, however many files that is, in one batch
        events = spark.readStream.schema(tables.events.schema).parquet(f"{work}/events/*")
        if state:
            events = newest_rows(events, ["user_id"], ["ts", "event_id"])
        writer = table.writer(events, f"{work}/checkpoint").outputMode("update" if state else "append")
        writer.trigger(availableNow=True).start().awaitTermination()
    return table.read(spark).select("user_id", "event_id", "ts", "event_type", "value")


@query(LATEST.format(where=""))
def stream_upsert(tables: Tables):
    return _streamed(tables, None)


@query(LATEST.format(where=""))
def stream_newer_wins(tables: Tables):
    """Later batches hold earlier events, which must not replace what is there."""
    return _streamed(tables, "ts")


@query(LATEST.format(where=""))
def stream_state_newer_wins(tables: Tables):
    """As before, but late rows are dropped by what the state store knows of their key, before they reach the table."""
    return _streamed(tables, "ts", state=True)
