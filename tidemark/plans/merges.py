"""Merge queries: every operation and option on the orders scenario and its variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import append_rows, delete, insert, insert_absent, merge, sync, table_diff, table_diff_digest, update, upsert
from ..functions import is_type_default
from ..sources import from_pages, from_reader, from_table
from ..spec import TableSpec
from .registry import Tables, query
from .scenario import CHANGED, COLUMNS, INPUTS, ORDERS, assigned, columns_of, feed, stored

VALUES = COLUMNS[1:]
LEFT = "FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey"
ABSENT = f"SELECT {columns_of('s')} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"
UPSERTED = f"SELECT {assigned('s.o_orderkey IS NOT NULL', VALUES)} {LEFT} UNION ALL {ABSENT}"


def _feed_rows(df):
    return df.withColumnRenamed("__action", "action")


# --- sources and plain inserts --------------------------------------------------------


@query(INPUTS + f"SELECT {columns_of('t')} FROM t UNION ALL SELECT {columns_of('s')} FROM s")
def bulk_insert(tables: Tables):
    return append_rows(stored(tables), feed(tables), ORDERS)


@query(INPUTS + f"SELECT {columns_of('t')} FROM t UNION ALL {ABSENT}")
def insert_conflict_ignore(tables: Tables):
    return insert(stored(tables), feed(tables), ORDERS, on_conflict="ignore")


@query(INPUTS + f"""
SELECT {columns_of('t')} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT {columns_of('s')} FROM s""")
def insert_conflict_replace(tables: Tables):
    return insert(stored(tables), feed(tables), ORDERS, on_conflict="replace")


@query("SELECT * FROM orders")
def insert_conflict_error(tables: Tables):
    urgent = tables.orders.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'")
    return insert(stored(tables), urgent, ORDERS, on_conflict="error")


@query(INPUTS + UPSERTED)
def merge_from_table(tables: Tables):
    feed(tables).createOrReplaceTempView("order_feed")
    return upsert(stored(tables), from_table(tables.spark, "order_feed"), ORDERS).result


class _OrderPages:
    """Stands for a service that gives orders by rising key, some at a time."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, low: int, high: int, limit: int) -> list[tuple]:
        import pyarrow.parquet as pq

        found = pq.read_table(self.path, columns=COLUMNS, filters=[("o_orderkey", ">=", low), ("o_orderkey", "<=", high)])
        found = found.sort_by("o_orderkey").slice(0, limit)
        return list(zip(*(c.to_pylist() for c in found.columns)))


@query(INPUTS + f", part AS (SELECT {', '.join(COLUMNS)} FROM orders WHERE o_orderkey % 4000 >= 100 AND o_orderkey < 12000) "
       + UPSERTED.replace("JOIN s ON", "JOIN part AS s ON").replace("FROM s WHERE", "FROM part AS s WHERE"))
def merge_from_pages(tables: Tables):
    """The source hands out pages; tasks read their parts of its keys side by side, and the bound on the key reaches it."""
    schema = tables.orders.select(*COLUMNS).schema
    highest = tables.orders.agg(F.max("o_orderkey")).first()[0]
    pages = from_pages(tables.spark, schema, "o_orderkey", _OrderPages(f"{tables.folder}/orders.parquet"), 0, highest, partitions=4, page=2500)
    return upsert(stored(tables), pages.filter("o_orderkey % 4000 >= 100 AND o_orderkey < 12000"), ORDERS).result


@query("SELECT * FROM orders")
def merge_from_reader(tables: Tables):
    source = from_reader(tables.spark, "parquet", f"{tables.folder}/orders.parquet")
    return upsert(stored(tables), source, ORDERS).result


@query(INPUTS + UPSERTED)
def merge_column_mapping(tables: Tables):
    mapping = {"id": "o_orderkey", "customer": "o_custkey", "state": "o_orderstatus"}
    feed(tables).withColumnsRenamed({v: k for k, v in mapping.items()}).createOrReplaceTempView("renamed_feed")
    return upsert(stored(tables), from_table(tables.spark, "renamed_feed", mapping), ORDERS).result


@query(INPUTS + f", head AS (SELECT * FROM s ORDER BY o_totalprice, o_orderkey LIMIT 1000) "
       + UPSERTED.replace("JOIN s ON", "JOIN head AS s ON").replace("FROM s WHERE", "FROM head AS s WHERE"))
def merge_source_limit(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS, source_limit=1000,
                  ordinal=["o_totalprice", "o_orderkey"], on_duplicate="unchecked").result


@query(INPUTS + f"""
SELECT 'I' AS action, CAST(to_json({{o_orderkey: s.o_orderkey, o_custkey: s.o_custkey, o_orderstatus: s.o_orderstatus}}) AS VARCHAR) AS data
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
UNION ALL
SELECT 'U', CAST(to_json({{o_orderkey: s.o_orderkey, o_custkey: s.o_custkey, o_orderstatus: s.o_orderstatus}}) AS VARCHAR)
FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}""")
def audit_json(tables: Tables):
    def audit(changes):
        written = changes.filter(F.col("__action").isin("I", "U"))
        return written.select(F.col("__action").alias("action"),
                              F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus")).alias("data"))

    return upsert(stored(tables), feed(tables), ORDERS).post_process(audit)


# --- operations -----------------------------------------------------------------------


@query(INPUTS + UPSERTED)
def merge_upsert(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS).result


@query(INPUTS + UPSERTED)
def merge_upsert_split(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS, strategy="split").result


@query(INPUTS + UPSERTED)
def merge_upsert_outer(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS, strategy="outer", join_hint="merge").result


@query(INPUTS + f"SELECT {assigned('s.o_orderkey IS NOT NULL', VALUES)} {LEFT}")
def merge_update(tables: Tables):
    return update(stored(tables), feed(tables), ORDERS).result


@query(INPUTS + f"SELECT {columns_of('t')} {LEFT} WHERE s.o_orderkey IS NULL")
def merge_delete(tables: Tables):
    return delete(stored(tables), feed(tables), ORDERS).result


@query(INPUTS + f"SELECT {columns_of('s')} FROM s")
def merge_sync(tables: Tables):
    return sync(stored(tables), feed(tables), ORDERS).result


@query(INPUTS + f"SELECT {columns_of('s')} FROM s UNION ALL SELECT {columns_of('t')} {LEFT} "
       "WHERE s.o_orderkey IS NULL AND NOT coalesce(t.o_totalprice < 100000, false)")
def merge_sync_filter(tables: Tables):
    return sync(stored(tables), feed(tables), ORDERS, delete_filter="o_totalprice < 100000").result


@query(INPUTS + f"""SELECT {columns_of('s')} FROM s UNION ALL
SELECT t.o_orderkey, t.o_custkey, 'D', t.o_totalprice, t.o_orderdate, t.o_orderpriority {LEFT} WHERE s.o_orderkey IS NULL""")
def merge_soft_delete(tables: Tables):
    return sync(stored(tables), feed(tables), ORDERS, soft_delete={"o_orderstatus": "D"}).result


@query(INPUTS + f"SELECT {columns_of('t')} FROM t UNION ALL {ABSENT}")
def merge_insert_only(tables: Tables):
    return insert_absent(stored(tables), feed(tables), ORDERS).result


@query(INPUTS + f"SELECT {columns_of('t')} FROM t UNION ALL {ABSENT}")
def merge_insert_if_absent(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS, include_on_update=[]).result


@query(INPUTS + f"SELECT {columns_of('t')} FROM t UNION ALL SELECT {columns_of('s')} FROM s")
def merge_without_key(tables: Tables):
    return upsert(stored(tables), feed(tables), TableSpec("orders")).result


# --- keys -----------------------------------------------------------------------------


@query("""
SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, n.price AS p_retailprice
FROM part p JOIN (SELECT p_name, max(p_retailprice) AS price FROM part GROUP BY p_name) n ON n.p_name = p.p_name""")
def merge_custom_key(tables: Tables):
    prices = tables.part.groupBy("p_name").agg(F.max("p_retailprice").alias("p_retailprice"))
    return update(tables.part, prices, TableSpec("part", key=("p_partkey",)), match_on=["p_name"],
                  include=["p_retailprice"]).result


def _supply(tables: Tables, returned: str):
    rows = tables.lineitem.filter(F.col("l_returnflag") != returned)
    return rows.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("lines")
    )


@query("""
WITH t AS (SELECT l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS lines
           FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
     s AS (SELECT l_partkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS lines
           FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL)
SELECT coalesce(t.l_partkey, s.l_partkey) AS l_partkey, coalesce(t.l_suppkey, s.l_suppkey) AS l_suppkey,
       coalesce(s.quantity, t.quantity) AS quantity, coalesce(s.lines, t.lines) AS lines
FROM t FULL JOIN s ON t.l_partkey = s.l_partkey AND t.l_suppkey = s.l_suppkey""")
def merge_composite_key(tables: Tables):
    spec = TableSpec("supply", key=("l_partkey", "l_suppkey"))
    return upsert(_supply(tables, "R"), _supply(tables, "A"), spec).result


SEGMENTS = """
WITH t AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_name, c_acctbal
           FROM customer),
     s AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS c_mktsegment,
                  c_name, c_acctbal + 1 AS c_acctbal FROM customer)
"""


def _segments(tables: Tables):
    segment, owing = F.col("c_mktsegment"), F.col("c_acctbal") < 0
    t = tables.customer.select("c_custkey", F.when(~owing, segment).alias("c_mktsegment"), "c_name", "c_acctbal")
    hidden = owing | (segment == "MACHINERY")
    s = tables.customer.select("c_custkey", F.when(~hidden, segment).alias("c_mktsegment"), "c_name",
                               (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return t, s


def _segment_changes(match: str) -> str:
    return SEGMENTS + f"""
SELECT CASE WHEN t.c_custkey IS NULL THEN 'I' ELSE 'U' END AS action, s.c_custkey, s.c_mktsegment, s.c_name, s.c_acctbal
FROM s LEFT JOIN t ON t.c_custkey = s.c_custkey AND {match}"""


@query(_segment_changes("t.c_mktsegment IS NOT DISTINCT FROM s.c_mktsegment"))
def merge_null_safe_key(tables: Tables):
    t, s = _segments(tables)
    spec = TableSpec("segment", key=("c_custkey", "c_mktsegment"), nullable=frozenset({"c_mktsegment"}))
    return _feed_rows(upsert(t, s, spec).changes)


@query(_segment_changes("t.c_mktsegment = s.c_mktsegment"))
def merge_plain_null_key(tables: Tables):
    t, s = _segments(tables)
    spec = TableSpec("segment", key=("c_custkey", "c_mktsegment"), nullable=frozenset({"c_mktsegment"}))
    return _feed_rows(upsert(t, s, spec, null_safe_keys=False).changes)


# --- what is compared, assigned and allowed -------------------------------------------


@query(INPUTS + f"SELECT 'U' AS action, {columns_of('s')} FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}")
def merge_noop_suppressed(tables: Tables):
    return _feed_rows(update(stored(tables), feed(tables), ORDERS).changes)


@query(INPUTS + f"SELECT 'U' AS action, {columns_of('s')} FROM t JOIN s ON s.o_orderkey = t.o_orderkey")
def merge_always_update(tables: Tables):
    return _feed_rows(update(stored(tables), feed(tables), ORDERS, always_update=True).changes)


STATUS_CHANGED = "s.o_orderkey IS NOT NULL AND s.o_orderstatus IS DISTINCT FROM t.o_orderstatus"


@query(INPUTS + f"SELECT {assigned(STATUS_CHANGED, VALUES)} {LEFT}")
def merge_compare_subset(tables: Tables):
    return update(stored(tables), feed(tables), ORDERS, include_on_compare=["o_orderstatus"]).result


BUT_DATE = [c for c in VALUES if c != "o_orderdate"]


@query(INPUTS + f"SELECT {assigned('s.o_orderkey IS NOT NULL', BUT_DATE)} {LEFT} UNION ALL {ABSENT}")
def merge_insert_only_columns(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS, exclude_on_update=["o_orderdate"]).result


@query(INPUTS + f"SELECT {assigned('s.o_orderdate > t.o_orderdate', VALUES)} {LEFT} UNION ALL {ABSENT}")
def merge_newer_wins(tables: Tables):
    return upsert(stored(tables), feed(tables), ORDERS, where="s.o_orderdate > t.o_orderdate").result


@query(INPUTS + f"SELECT {assigned('s.o_totalprice + 50 > 100000', VALUES)} {LEFT} UNION ALL {ABSENT}")
def merge_extra_columns(tables: Tables):
    """A predicate over a source column that the table does not have."""
    wider = feed(tables).withColumn("gross", F.col("o_totalprice") + 50)
    return upsert(stored(tables), wider, ORDERS, where="s.gross > 100000").result


@query(INPUTS + f"SELECT 'D' AS __action, {columns_of('t')} FROM t")
def merge_empty_source(tables: Tables):
    """A sync with nothing empties the table."""
    return sync(stored(tables), feed(tables).filter("false"), ORDERS).changes


@query(INPUTS + f"SELECT {assigned('s.o_orderkey IS NOT NULL', ['o_totalprice'])} {LEFT}")
def update_included_columns(tables: Tables):
    return update(stored(tables), feed(tables), ORDERS, include=["o_totalprice"]).result


@query(INPUTS + f"""
SELECT {assigned('s.o_orderkey IS NOT NULL', ['o_orderstatus', 'o_orderdate', 'o_orderpriority'])} {LEFT}""")
def update_excluded_columns(tables: Tables):
    return update(stored(tables), feed(tables), ORDERS, exclude=["o_totalprice", "o_custkey"]).result


@query(INPUTS + f"""SELECT {columns_of('t')} FROM t UNION ALL
SELECT s.o_orderkey, s.o_custkey, 'N', s.o_totalprice, s.o_orderdate, 'LOAD ' || s.o_custkey
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def merge_constant_columns(tables: Tables):
    source = feed(tables).drop("o_orderstatus", "o_orderpriority")
    per_row = lambda r: F.concat(F.lit("LOAD "), r.o_custkey.cast("string"))
    return insert_absent(stored(tables), source, ORDERS,
                         constants={"o_orderstatus": "N", "o_orderpriority": per_row}).result


# --- versions -------------------------------------------------------------------------

VERSIONED = INPUTS + """
, tv AS (SELECT t.*, CAST(CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 1 END AS BIGINT) AS version FROM t),
  sv AS (SELECT s.*, CAST(1 AS BIGINT) AS version FROM s)
"""
VERSION_SPEC = TableSpec("orders", key=("o_orderkey",), version="version")


def _versioned(tables: Tables):
    t = stored(tables).withColumn("version", F.when(F.col("o_orderstatus") == "O", 3).otherwise(1).cast("bigint"))
    return t, feed(tables).withColumn("version", F.lit(1).cast("bigint"))


@query(VERSIONED + f"""
SELECT {assigned(CHANGED + ' AND s.version = t.version', VALUES)},
       CASE WHEN {CHANGED} AND s.version = t.version THEN t.version + 1 ELSE t.version END AS version
FROM tv AS t LEFT JOIN sv AS s ON s.o_orderkey = t.o_orderkey""")
def merge_version_check(tables: Tables):
    t, s = _versioned(tables)
    return update(t, s, VERSION_SPEC, check_version=True).result


@query(VERSIONED + """SELECT t.o_orderkey, t.version AS target_version, s.version AS source_version
FROM tv AS t JOIN sv AS s ON s.o_orderkey = t.o_orderkey WHERE t.version <> s.version""")
def merge_conflicts(tables: Tables):
    t, s = _versioned(tables)
    return update(t, s, VERSION_SPEC, check_version=True).conflicts


@query(VERSIONED + f"""
SELECT (SELECT count(*) FROM s) AS input_rows, count(*) AS output_rows, (SELECT count(*) FROM s) - count(*) AS skipped
FROM tv AS t JOIN sv AS s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED} AND t.version = s.version""")
def merge_skipped(tables: Tables):
    t, s = _versioned(tables)
    return update(t, s, VERSION_SPEC, check_version=True).skipped


@query(VERSIONED + f"""
SELECT {columns_of('t')}, s.version FROM tv AS t JOIN sv AS s ON s.o_orderkey = t.o_orderkey WHERE s.version <> t.version""")
def merge_ignore_version(tables: Tables):
    t, s = _versioned(tables)
    merged = update(t, s, VERSION_SPEC, ignore_version=True, include=["version"])
    return merged.changes.drop("__action")


# --- what a merge reports -------------------------------------------------------------


@query(INPUTS + f"""
SELECT (SELECT count(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)) AS inserted,
       (SELECT count(*) FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}) AS updated,
       (SELECT count(*) {LEFT} WHERE s.o_orderkey IS NULL) AS deleted""")
def merge_stats(tables: Tables):
    return sync(stored(tables), feed(tables), ORDERS).stats


@query(INPUTS + f"""
SELECT 'I' AS action, {columns_of('s')} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
UNION ALL SELECT 'U', {columns_of('s')} FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}""")
def merge_changes(tables: Tables):
    return _feed_rows(upsert(stored(tables), feed(tables), ORDERS).changes)


@query(INPUTS + f"SELECT 'D' AS action, {columns_of('t')} FROM t JOIN s ON s.o_orderkey = t.o_orderkey")
def merge_delete_changes(tables: Tables):
    return _feed_rows(delete(stored(tables), feed(tables), ORDERS).changes)


DIFFERENCE = INPUTS + f"""
SELECT 'I' AS action, {columns_of('s')} FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)
UNION ALL SELECT 'U', {columns_of('s')} FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}
UNION ALL SELECT 'D', {columns_of('t')} {LEFT} WHERE s.o_orderkey IS NULL"""


@query(DIFFERENCE, name="table_diff")
def table_difference(tables: Tables):
    return _feed_rows(table_diff(stored(tables), feed(tables), ORDERS))


@query(DIFFERENCE, name="table_diff_digest")
def table_difference_by_digests(tables: Tables):
    """Only key ranges whose digests differ are joined."""
    return _feed_rows(table_diff_digest(stored(tables), feed(tables), ORDERS, ranges=256))


@query(INPUTS + UPSERTED)
def merge_upsert_bitmap(tables: Tables):
    """Rows whose key no source row can have are not shuffled."""
    return upsert(stored(tables), feed(tables), ORDERS, strategy="bitmap").result


@query(INPUTS + f"SELECT {columns_of('s')} FROM s")
def merge_sync_bitmap(tables: Tables):
    return sync(stored(tables), feed(tables), ORDERS, strategy="bitmap", bitmap_bits=1 << 15).result


@query(INPUTS + f"SELECT 'D' AS action, {columns_of('t')} FROM t JOIN s ON s.o_orderkey = t.o_orderkey")
def merge_delete_intervals(tables: Tables):
    """The removed rows are read by intervals of the source's keys."""
    return _feed_rows(delete(stored(tables), feed(tables), ORDERS, key_intervals=16).changes)


# --- generated values -----------------------------------------------------------------

INVOICES = TableSpec("orders", key=("o_orderkey",), identity="o_orderkey")
NUMBERED = INPUTS + """
, fresh AS (SELECT s.*, (SELECT max(o_orderkey) FROM t) + row_number() OVER (ORDER BY s.o_orderkey) AS id FROM s)
"""
NUMBERED_COLUMNS = "id AS o_orderkey, " + ", ".join(VALUES)


def _unnumbered(tables: Tables):
    return feed(tables).withColumn("place", F.col("o_orderkey")).withColumn("o_orderkey", F.lit(None).cast("bigint"))


@query(NUMBERED + f"SELECT {columns_of('t')} FROM t UNION ALL SELECT {NUMBERED_COLUMNS} FROM fresh")
def merge_identity_order(tables: Tables):
    return upsert(stored(tables), _unnumbered(tables), INVOICES, ordinal="place").result


@query(NUMBERED + f"SELECT o_orderkey AS place, {NUMBERED_COLUMNS.replace('id AS o_orderkey', 'id')} FROM fresh")
def merge_output_identity(tables: Tables):
    loaded = upsert(stored(tables), _unnumbered(tables), INVOICES, ordinal="place").loaded_back()
    return loaded.withColumnsRenamed({"__ordinal": "place", "o_orderkey": "id"})


PARTIES = """
WITH s AS (SELECT c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, 0 AS kind, c_custkey AS place FROM customer
           UNION ALL SELECT s_name, s_nationkey, s_acctbal, 'SUPPLIER', 1, s_suppkey FROM supplier),
 fresh AS (SELECT s.*, row_number() OVER (ORDER BY kind, place) AS rank FROM s
           WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_name = s.c_name))
"""


@query(PARTIES + """
SELECT c.c_custkey, s.c_name FROM customer c JOIN s ON s.c_name = c.c_name
UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + rank, c_name FROM fresh""")
def merge_output_identity_by_name(tables: Tables):
    """Matched rows report the identity they have, new rows the one they were given."""
    customers = tables.customer.select("c_name", "c_nationkey", (F.col("c_acctbal") + 1).alias("c_acctbal"),
                                       "c_mktsegment", F.lit(0).alias("kind"), F.col("c_custkey").alias("place"))
    suppliers = tables.supplier.select("s_name", "s_nationkey", "s_acctbal", F.lit("SUPPLIER"), F.lit(1), "s_suppkey")
    spec = TableSpec("customer", key=("c_custkey",), identity="c_custkey")
    merged = upsert(tables.customer, customers.union(suppliers), spec, match_on=["c_name"], ordinal=["kind", "place"],
                    on_duplicate="error")
    return merged.loaded_back("identity").select("c_custkey", "c_name")


@query(INPUTS + UPSERTED)
def merge_keep_identity(tables: Tables):
    return upsert(stored(tables), feed(tables), INVOICES, keep_identity=True).result


@query(INPUTS + f"""SELECT {columns_of('t')} FROM t UNION ALL
SELECT s.o_orderkey, s.o_custkey, 'N', s.o_totalprice, s.o_orderdate, '0-NONE'
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def merge_defaults(tables: Tables):
    """One column is NULL in every source row, another is not in the source at all."""
    spec = TableSpec("orders", key=("o_orderkey",),
                     defaults={"o_orderstatus": "N", "o_orderpriority": "0-NONE", "o_totalprice": 1.0})
    source = feed(tables).drop("o_orderpriority").withColumn("o_orderstatus", F.lit(None).cast("string"))
    return insert_absent(stored(tables), source, spec).result


@query(INPUTS + f"""SELECT {columns_of('t')} FROM t UNION ALL
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate,
       CASE WHEN s.o_totalprice < 200000 THEN '0-NONE' ELSE s.o_orderpriority END
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def merge_defaults_by_row(tables: Tables):
    spec = TableSpec("orders", key=("o_orderkey",), defaults={"o_orderpriority": "0-NONE"})
    known = F.when(F.col("o_totalprice") >= 200000, F.col("o_orderpriority"))
    return insert_absent(stored(tables), feed(tables).withColumn("o_orderpriority", known), spec,
                         use_defaults="when_null").result


@query("SELECT doc_id, quality = 0 AS quality_default, toxic = 0 AS toxic_default FROM labels", name="is_type_default")
def type_defaults(tables: Tables):
    labels = tables.labels
    return labels.select("doc_id", *[
        is_type_default(F.col(c), labels.schema[c].dataType).alias(f"{c}_default") for c in ("quality", "toxic")
    ])


@query(INPUTS + f"""
, u AS ({UPSERTED}) SELECT u.*, CAST(floor(o_totalprice / 1000) AS BIGINT) AS price_band FROM u""")
def merge_computed_column(tables: Tables):
    band = F.floor(F.col("o_totalprice") / 1000).cast("bigint")
    spec = TableSpec("orders", key=("o_orderkey",), computed={"price_band": band})
    return upsert(stored(tables).withColumn("price_band", band), feed(tables), spec).result


@query(INPUTS + f"""
SELECT {columns_of('s')}, CAST('2024-01-01' AS TIMESTAMP) AS period_start, t.o_orderdate + INTERVAL 1 DAY AS period_end
FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED}""")
def merge_period_columns(tables: Tables):
    t = stored(tables).withColumns({"period_start": F.col("o_orderdate"),
                                    "period_end": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")})
    spec = TableSpec("orders", key=("o_orderkey",), period=("period_start", "period_end"))
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    return update(t, feed(tables), spec, as_of=now).changes.drop("__action")


# --- mixed changes --------------------------------------------------------------------


@query(INPUTS + f"""
SELECT (SELECT count(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)) AS inserted,
       (SELECT count(*) FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE {CHANGED})
         + (SELECT count(*) {LEFT} WHERE s.o_orderkey IS NULL AND t.o_totalprice < 100000) AS updated,
       CAST(0 AS BIGINT) AS deleted""")
def merge_soft_delete_stats(tables: Tables):
    """Softly deleted rows count as updated, within the filter only."""
    return merge(stored(tables), feed(tables), ORDERS, "sync", delete_filter=lambda t: t.o_totalprice < 100000,
                 soft_delete={"o_orderstatus": lambda t: F.concat(F.lit("~"), t.o_orderstatus)}).stats
