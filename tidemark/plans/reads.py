"""Keyed reads, duplicate keys and row types."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dedupe, duplicate_keys, insert_absent, lookup, update, upsert
from ..operators import rows_of_type, split_types, union_types, with_type
from ..sources import from_table
from ..spec import TableSpec
from .registry import Tables, query

PART = TableSpec("part", key=("p_partkey",))
#: Part names to read by, and brands, which no part is named after.
NAMES = "SELECT DISTINCT p_name FROM part UNION SELECT DISTINCT p_brand FROM part"


def _names(tables: Tables):
    part = tables.part
    return part.select("p_name").union(part.select("p_brand")).distinct()


@query(f"""
WITH names AS ({NAMES}), firsts AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name)
SELECT n.p_name, coalesce(p.p_size, -1) AS p_size, p.p_partkey, p.p_brand, p.p_type, p.p_retailprice
FROM names n LEFT JOIN firsts f ON f.p_name = n.p_name LEFT JOIN part p ON p.p_partkey = f.k""")
def read_enrich(tables: Tables):
    asked = _names(tables).withColumn("p_size", F.lit(-1))
    return lookup(asked, tables.part, PART, match_on=["p_name"], first_by=["p_partkey"])


@query(f"SELECT p.* FROM part p JOIN ({NAMES}) n ON n.p_name = p.p_name")
def read_replace(tables: Tables):
    return lookup(_names(tables), tables.part, PART, mode="replace", match_on=["p_name"])


@query("SELECT p.* FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey WHERE l.l_returnflag = 'R'")
def read_replace_repeated(tables: Tables):
    """A part comes as often as its key was asked for."""
    asked = tables.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return lookup(asked, tables.part, PART, mode="replace")


@query("SELECT r.* FROM events e JOIN region r ON r.r_regionkey = CASE WHEN e.user_id % 10 < 8 THEN 1 ELSE e.user_id % 5 END")
def read_hot_key(tables: Tables):
    """Most requests ask for one key."""
    key = F.when(F.col("user_id") % 10 < 8, F.lit(1)).otherwise(F.col("user_id") % 5)
    asked = tables.events.select(key.cast(tables.region.schema["r_regionkey"].dataType).alias("r_regionkey"))
    return lookup(asked, tables.region, TableSpec("region", key=("r_regionkey",)), mode="replace")


@query("SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_tax > 0.07)")
def read_replace_distinct(tables: Tables):
    asked = tables.lineitem.filter("l_returnflag = 'R' AND l_tax > 0.07").select(F.col("l_partkey").alias("p_partkey"))
    return lookup(asked, tables.part, PART, mode="replace", duplicates="drop")


@query("""SELECT o.* FROM orders o WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem
  WHERE l_shipdate >= (SELECT max(l_shipdate) - INTERVAL 30 DAY FROM lineitem) AND l_orderkey % 1000 < 40)""")
def read_key_intervals(tables: Tables):
    """Late lines of clustered orders: the scan reads the intervals in which their keys lie."""
    latest = tables.lineitem.agg((F.max("l_shipdate") - F.expr("INTERVAL 30 DAY")).alias("since")).scalar()
    asked = tables.lineitem.filter((F.col("l_shipdate") >= latest) & (F.col("l_orderkey") % 1000 < 40))
    orders = TableSpec("orders", key=("o_orderkey",))
    return lookup(asked.select(F.col("l_orderkey").alias("o_orderkey")), tables.orders, orders, mode="replace", duplicates="drop", key_intervals=24)


@query("SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey AS p_partkey, p.p_brand "
       "FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey")
def read_projection(tables: Tables):
    lines = tables.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("p_partkey"))
    return lookup(lines, tables.part, PART, columns=["p_brand"])


SUPPLY = "SELECT l_partkey, l_suppkey, count(*) AS lines FROM lineitem GROUP BY l_partkey, l_suppkey"


@query(f"""
SELECT c.l_orderkey, c.l_partkey, c.l_suppkey, s.lines
FROM lineitem c LEFT JOIN (SELECT * FROM ({SUPPLY}) WHERE lines > 1) s
  ON s.l_partkey = c.l_partkey AND s.l_suppkey = c.l_suppkey WHERE c.l_returnflag = 'A'""")
def read_composite_key(tables: Tables):
    supply = tables.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("lines"))
    asked = tables.lineitem.filter("l_returnflag = 'A'").select("l_orderkey", "l_partkey", "l_suppkey")
    return lookup(asked, supply.filter("lines > 1"), TableSpec("supply", key=("l_partkey", "l_suppkey")))


@query("SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey")
def read_binary_key(tables: Tables):
    """The key is a digest, compared as bytes."""
    def digest(key):
        return F.unhex(F.md5(key.cast("string")))

    people = tables.customer.select(digest(F.col("c_custkey")).alias("id"), "c_custkey", "c_mktsegment")
    asked = tables.orders.select("o_orderkey", digest(F.col("o_custkey")).alias("id"))
    return lookup(asked, people, TableSpec("customer", key=("id",))).drop("id")


@query("""SELECT l.doc_id, l.quality, d.lang, d.n_chars
FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id AND d.n_chars > 500""")
def read_with_row_filter(tables: Tables):
    spec = TableSpec("documents", key=("doc_id",), row_filter="n_chars > 500")
    return lookup(tables.labels.select("doc_id", "quality"), tables.documents, spec, columns=["lang", "n_chars"])


@query("SELECT l.doc_id, d.lang FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id")
def read_ignoring_row_filter(tables: Tables):
    spec = TableSpec("documents", key=("doc_id",), row_filter="n_chars > 500")
    return lookup(tables.labels.select("doc_id"), tables.documents, spec, columns=["lang"], ignore_row_filter=True)


@query("SELECT c.c_custkey, v.n_name AS nation FROM customer c LEFT JOIN nation v ON v.n_nationkey = c.c_nationkey")
def read_from_view(tables: Tables):
    """A view serves as the relation read."""
    tables.nation.createOrReplaceTempView("nation_names")
    names = from_table(tables.spark, "nation_names", {"n_nationkey": "c_nationkey", "n_name": "nation"})
    asked = tables.customer.select("c_custkey", "c_nationkey")
    return lookup(asked, names, TableSpec("nation", key=("c_nationkey",)), columns=["nation"]).drop("c_nationkey")


# --- duplicate keys -------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS \"count\" FROM lineitem GROUP BY ALL HAVING count(*) > 1",
       name="duplicate_keys")
def duplicate_line_keys(tables: Tables):
    return duplicate_keys(tables.lineitem, ["l_orderkey", "l_linenumber"])


def _ranked(order: str) -> str:
    """Equal ordinals are settled by the remaining columns."""
    columns = "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
    by = ", ".join(f"{c} {order}" for c in columns.split())
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {by}) AS rn FROM lineitem) WHERE rn = 1"""


@query(_ranked("DESC"))
def dedupe_source_last(tables: Tables):
    return dedupe(tables.lineitem, ["l_orderkey", "l_linenumber"], "last", ["l_partkey", "l_suppkey"])


@query(_ranked("ASC"))
def dedupe_source_first(tables: Tables):
    return dedupe(tables.lineitem, ["l_orderkey", "l_linenumber"], "first", ["l_partkey", "l_suppkey"])


# --- row types ------------------------------------------------------------------------

PARTY = """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
  'Customer' AS "Discriminator"
FROM customer UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, 'Supplier' FROM supplier"""


def _parties(tables: Tables):
    c = tables.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                               F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = tables.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
                               F.col("s_acctbal").alias("balance"))
    return with_type(c, "Customer"), with_type(s, "Supplier")


@query(PARTY)
def tph_discriminator(tables: Tables):
    """Two row types written to one table."""
    customers, suppliers = _parties(tables)
    spec = TableSpec("party", key=("name",))
    suppliers = suppliers.withColumn("segment", F.lit(None).cast("string"))
    return insert_absent(customers, suppliers, spec).result


@query(f"SELECT * FROM ({PARTY}) WHERE \"Discriminator\" = 'Supplier'")
def tph_rows_of_type(tables: Tables):
    return rows_of_type(union_types(*_parties(tables)), "Supplier")


@query(PARTY)
def derived_columns_union(tables: Tables):
    """The base type's rows carry the columns of all derived types."""
    return union_types(*_parties(tables))


def _split(tables: Tables):
    wide = tables.customer.select("c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") * 2).alias("c_acctbal"),
                                  F.lower("c_mktsegment").alias("c_mktsegment"))
    return split_types(wide, ["c_custkey"], ["c_name", "c_nationkey"])


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def tpt_split_base(tables: Tables):
    base, _ = _split(tables)
    have = tables.customer.filter("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey")
    return upsert(have, base, TableSpec("person", key=("c_custkey",))).result


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
CASE WHEN c_mktsegment = 'BUILDING' THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def tpt_split(tables: Tables):
    _, derived = _split(tables)
    have = tables.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return update(have, derived, TableSpec("customer", key=("c_custkey",)), where="t.c_mktsegment = 'BUILDING'").result
