"""Row and column mapping: converters, nested structs, JSON, precision."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import upsert
from ..functions import (ADD_ONE_DAY, EPOCH_MICROS, NUMBER_BYTES, convert_columns, enum_to_number, enum_to_text,
                         flatten_columns, json_column, nest_columns, parent_key, parse_json_column, quote,
                         restore_columns, round_timestamp, truncate_timestamp, with_srid)
from ..operators.skew import join_many_to_one
from ..spec import TableSpec
from .registry import Tables, query
from .scenario import INPUTS, feed, stored

STATUS = {"F": 0, "O": 1, "P": 2}


@query("SELECT * FROM orders")
def convert_roundtrip(tables: Tables):
    converters = {"o_orderstatus": enum_to_number(STATUS), "o_orderdate": ADD_ONE_DAY, "o_custkey": NUMBER_BYTES}
    return restore_columns(convert_columns(tables.orders, converters), converters)


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS o_orderstatus,
  o_orderdate + INTERVAL 1 DAY AS o_orderdate, printf('%016X', o_custkey) AS o_custkey FROM orders""")
def convert_stored(tables: Tables):
    """What the table holds."""
    converters = {"o_orderstatus": enum_to_number(STATUS), "o_orderdate": ADD_ONE_DAY, "o_custkey": NUMBER_BYTES}
    rows = tables.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_custkey")
    return convert_columns(rows, converters).withColumn("o_custkey", F.hex("o_custkey"))


@query("SELECT event_id, epoch_us(ts) AS ts FROM events")
def convert_instant(tables: Tables):
    return convert_columns(tables.events.select("event_id", "ts"), {"ts": EPOCH_MICROS})


@query("SELECT doc_id, CASE quality WHEN 0 THEN 'Poor' WHEN 1 THEN 'Good' END AS quality, toxic FROM labels",
       name="enum_to_string")
def enum_names(tables: Tables):
    return convert_columns(tables.labels, {"quality": enum_to_text({0: "Poor", 1: "Good"})})


@query(INPUTS + """SELECT s.o_orderkey,
  CAST(CASE s.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'X' THEN 3 END AS INTEGER) AS o_orderstatus
FROM t JOIN s ON s.o_orderkey = t.o_orderkey WHERE s.o_orderstatus IS DISTINCT FROM t.o_orderstatus""")
def merge_converted(tables: Tables):
    """The source holds names, the table numbers; they are compared as stored."""
    members = {**STATUS, "X": 3}
    spec = TableSpec("orders", key=("o_orderkey",), converters={"o_orderstatus": enum_to_number(members)})
    table = convert_columns(stored(tables), spec.converters).select("o_orderkey", "o_orderstatus")
    return upsert(table, feed(tables), spec, convert=True, include_on_update=["o_orderstatus"]).changes.filter(
        "__action = 'U'").drop("__action")


def _nested(tables: Tables):
    return tables.customer.select("c_custkey", F.struct(
        "c_name", F.struct("c_nationkey", "c_mktsegment").alias("home")).alias("owner"), "c_acctbal")


FLAT = """SELECT c_custkey, c_name AS owner_c_name, c_nationkey AS owner_home_c_nationkey, c_mktsegment AS segment,
  c_acctbal FROM customer"""


@query(FLAT)
def flatten_struct(tables: Tables):
    return flatten_columns(_nested(tables), names={"owner.home.c_mktsegment": "segment"})


@query("SELECT c_custkey, c_nationkey AS owner_home_c_nationkey, c_mktsegment AS owner_home_c_mktsegment FROM customer")
def flatten_struct_selected(tables: Tables):
    return flatten_columns(_nested(tables), include=["c_custkey", "owner.home"])


@query("SELECT * FROM customer")
def unflatten_struct(tables: Tables):
    flat = flatten_columns(_nested(tables))
    nested = nest_columns(flat, {"owner": {"c_name": "owner_c_name", "home": {
        "c_nationkey": "owner_home_c_nationkey", "c_mktsegment": "owner_home_c_mktsegment"}}})
    return nested.select("c_custkey", "owner.c_name", "owner.home.c_nationkey", "c_acctbal", "owner.home.c_mktsegment")


@query("""SELECT c_custkey, c_acctbal,
  CAST(to_json({c_name: c_name, home: {c_nationkey: c_nationkey, c_mktsegment: c_mktsegment}}) AS VARCHAR) AS owner
FROM customer""")
def json_column_text(tables: Tables):
    return json_column(_nested(tables), "owner")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) + 1 AS k FROM events")
def json_column_roundtrip(tables: Tables):
    parsed = parse_json_column(tables.events.select("event_id", "props"), {"props": "k int"})
    changed = parsed.withColumn("props", F.struct((F.col("props.k") + 1).alias("k")))
    stored_text = json_column(changed, "props")
    return parse_json_column(stored_text, {"props": "k int"}).select("event_id", "props.k")


@query("SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def timestamp_truncate(tables: Tables):
    return tables.events.select("event_id", truncate_timestamp(F.col("ts"), 3).alias("ts"))


@query("SELECT event_id, make_timestamp(((epoch_us(ts) + 500) // 1000) * 1000) AS ts FROM events")
def timestamp_round(tables: Tables):
    return tables.events.select("event_id", round_timestamp(F.col("ts"), 3).alias("ts"))


@query("SELECT o.o_orderkey, c.c_custkey AS customer_c_custkey FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey")
def foreign_key_from_reference(tables: Tables):
    """The order holds its customer as a nested row; only the customer's key is stored."""
    nested = join_many_to_one(tables.orders, tables.customer, ["o_custkey"], ["c_custkey"], "inner").select(
        "t.o_orderkey", F.struct("s.c_custkey", "s.c_name").alias("customer"))
    return parent_key(nested, "customer", "c_custkey")


@query(INPUTS + """SELECT s.o_orderkey, s.o_orderstatus, hex(encode(CAST(s.o_custkey AS VARCHAR))) AS place,
  CAST(4326 AS INTEGER) AS place_srid
FROM t JOIN s ON s.o_orderkey = t.o_orderkey""")
def spatial_bytes(tables: Tables):
    """Spatial columns travel as bytes with their reference system and are never compared."""
    def places(df):
        place = F.col("o_custkey").cast("string").cast("binary").alias("place")
        return with_srid(df.select("o_orderkey", "o_orderstatus", place), "place")

    spec = TableSpec("orders", key=("o_orderkey",), spatial=("place",))
    changes = upsert(places(stored(tables)), places(feed(tables)), spec).changes.filter("__action = 'U'")
    return changes.drop("__action").withColumn("place", F.hex("place"))


@query(INPUTS + f"SELECT s.o_orderkey, s.o_orderstatus AS \"o.order`status\" FROM t JOIN s ON s.o_orderkey = t.o_orderkey "
       "WHERE s.o_orderstatus IS DISTINCT FROM t.o_orderstatus")
def reserved_characters(tables: Tables):
    """Dots and quotes in a column name."""
    odd = "o.order`status"
    t = stored(tables).select("o_orderkey", F.col("o_orderstatus").alias(odd))
    s = feed(tables).select("o_orderkey", F.col("o_orderstatus").alias(odd))
    changes = upsert(t, s, TableSpec("orders", key=("o_orderkey",))).changes
    return changes.filter("__action = 'U'").select("o_orderkey", F.col(quote(odd)))
