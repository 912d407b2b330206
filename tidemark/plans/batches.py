"""Predicate updates and deletes over the orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import Aggregate, Lookup, batch_delete, batch_update, cascade_delete
from ..functions import bit_and, bit_not, bit_or, bit_xor, concat_text, enum_to_text, int_divide
from ..operators.batch import Related, changed_values, child_value
from .registry import Tables, query

@query("SELECT * FROM orders WHERE NOT (o_totalprice < 50000 AND o_orderstatus = 'F')", name="batch_delete")
def batch_delete_rows(tables: Tables):
    return batch_delete(tables.orders, "o_totalprice < 50000 AND o_orderstatus = 'F'").result


@query("SELECT * FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_totalprice <= 400000")
def batch_delete_list(tables: Tables):
    named = F.col("o_orderpriority").isin("1-URGENT", "5-LOW") | (F.col("o_totalprice") > 400000)
    return batch_delete(tables.orders, named).result


@query("SELECT * FROM orders")
def batch_delete_empty_list(tables: Tables):
    return batch_delete(tables.orders, F.col("o_orderpriority").isin([])).result


@query("SELECT count(*) AS affected FROM orders WHERE o_totalprice < 50000")
def batch_affected_count(tables: Tables):
    return batch_delete(tables.orders, "o_totalprice < 50000").affected_count


@query("SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def batch_delete_no_children(tables: Tables):
    return batch_delete(tables.orders, not_exists=[Related(tables.lineitem, {"o_orderkey": "l_orderkey"})]).result


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 100")
def batch_delete_top_n(tables: Tables):
    return batch_delete(tables.orders, key=["o_orderkey"], order_by=[F.col("o_totalprice").desc()], limit=100).result


@query("SELECT * FROM orders ORDER BY o_orderdate, o_orderkey OFFSET 9000")
def batch_delete_top_n_large(tables: Tables):
    """A limit of the order of the table itself."""
    return batch_delete(tables.orders, key=["o_orderkey"], order_by=["o_orderdate"], limit=9000).result


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN o_orderstatus ELSE 'N' END AS o_orderstatus
FROM orders""")
def batch_update_childless(tables: Tables):
    """An aggregate over no child rows is 0 in a predicate."""
    lines = Aggregate("lines", tables.lineitem, {"o_orderkey": "l_orderkey"}, {"n": F.count(F.lit(1))})
    orders = tables.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return batch_update(orders, {"o_orderstatus": "N"}, "lines.n = 0", aggregates=[lines]).result


@query("""SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
          ORDER BY o_orderdate, o_orderkey LIMIT 40 OFFSET 20)""")
def batch_delete_offset(tables: Tables):
    return batch_delete(tables.orders, "o_orderstatus = 'F'", key=["o_orderkey"], order_by=["o_orderdate"],
                        limit=40, offset=20).result


@query("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def batch_delete_ordered(tables: Tables):
    """An order without a limit has no effect."""
    return batch_delete(tables.orders, "o_orderstatus = 'F'", order_by=["o_orderdate"]).result


@query("""SELECT * FROM orders WHERE o_orderkey NOT IN (
  SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
  ORDER BY o_orderkey LIMIT 4 OFFSET 2)""")
def batch_delete_no_children_offset(tables: Tables):
    return batch_delete(tables.orders, not_exists=[Related(tables.lineitem, {"o_orderkey": "l_orderkey"})],
                        key=["o_orderkey"], order_by=["o_orderkey"], limit=4, offset=2).result


@query("""SELECT * REPLACE (CASE WHEN o_totalprice >= 100000 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_totalprice >= 100000 THEN 0 ELSE o_totalprice END AS o_totalprice) FROM orders""")
def batch_update_values(tables: Tables):
    """Default values are assigned only where they are asked for."""
    order = {"o_orderstatus": "Z", "o_totalprice": 0.0, "o_custkey": 0, "o_orderpriority": None}
    return batch_update(tables.orders, changed_values(order, ["o_totalprice"]), "o_totalprice >= 100000").result


@query("""SELECT * REPLACE (
  CASE WHEN o_totalprice >= 100000 THEN o_orderpriority || ' of ' || o_orderstatus ELSE o_orderpriority END
    AS o_orderpriority,
  CASE WHEN o_totalprice >= 100000 THEN (o_totalprice + 100) * 2 - 50 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_totalprice >= 100000 THEN o_custkey // 7 + xor((o_custkey & 12) | 3, 5) ELSE o_custkey END AS o_custkey
) FROM orders""")
def batch_update_expr(tables: Tables):
    """All expressions see the old row."""
    t = lambda c: F.col("t." + c)
    return batch_update(tables.orders, {
        "o_orderpriority": concat_text(t("o_orderpriority"), F.lit(" of "), t("o_orderstatus")),
        "o_totalprice": (t("o_totalprice") + 100) * 2 - 50,
        "o_custkey": int_divide(t("o_custkey"), F.lit(7))
        + bit_xor(bit_or(bit_and(t("o_custkey"), F.lit(12)), F.lit(3)), F.lit(5)),
    }, lambda o: o.o_totalprice >= 100000).result


@query("""SELECT doc_id, ~quality AS quality, CASE WHEN NOT (toxic = 1) THEN 1 ELSE 0 END AS toxic FROM labels""")
def batch_update_not(tables: Tables):
    labels = tables.labels
    return batch_update(labels, {
        "quality": lambda t: bit_not(t.quality, labels.schema["quality"].dataType),
        "toxic": lambda t: (~(t.toxic == 1)).cast("int"),
    }).result


@query("""SELECT o.* REPLACE (CASE WHEN o.o_totalprice < 50000
    THEN coalesce(CASE WHEN c.c_acctbal > 0 THEN c.c_mktsegment END, 'unassigned') ELSE o.o_orderstatus END AS o_orderstatus)
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey""")
def batch_update_lookup(tables: Tables):
    customers = tables.customer.withColumn("segment", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    return batch_update(tables.orders, {"o_orderstatus": F.coalesce(F.col("c.segment"), F.lit("unassigned"))},
                        "t.o_totalprice < 50000",
                        lookups=[Lookup("c", customers, {"o_custkey": "c_custkey"})]).result


@query("""SELECT o.* REPLACE (coalesce(n.n_name, '') AS o_orderstatus)
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def batch_update_lookup_chain(tables: Tables):
    """A chain of references: the order's customer's nation."""
    homes = tables.customer.join(tables.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "n_name")
    return batch_update(tables.orders, {"o_orderstatus": F.coalesce(F.col("home.n_name"), F.lit(""))},
                        lookups=[Lookup("home", homes, {"o_custkey": "c_custkey"}, unique=True)]).result


RETURNED = """(SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)"""


def _returned(tables: Tables) -> Aggregate:
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return Aggregate("returned", tables.lineitem, {"o_orderkey": "l_orderkey"}, {"total": total}, "l_returnflag = 'R'")


@query(f"""SELECT o.* REPLACE (coalesce(r.total, 0) AS o_totalprice)
  FROM orders o LEFT JOIN {RETURNED} r ON r.l_orderkey = o.o_orderkey""")
def batch_update_child_sum(tables: Tables):
    returned = _returned(tables)
    return batch_update(tables.orders, {"o_totalprice": child_value(returned, "total")}, aggregates=[returned]).result


@query("""SELECT o.* REPLACE (CAST(coalesce(r.n, 0) AS VARCHAR) AS o_orderstatus)
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) r ON r.l_orderkey = o.o_orderkey""")
def batch_update_child_text(tables: Tables):
    """A child aggregate written into a text column."""
    lines = Aggregate("lines", tables.lineitem, {"o_orderkey": "l_orderkey"}, {"n": F.count(F.lit(1))})
    return batch_update(tables.orders, {"o_orderstatus": child_value(lines, "n").cast("string")}, aggregates=[lines]).result


@query("""SELECT o.* REPLACE (CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'B' ELSE o.o_orderstatus END AS o_orderstatus)
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def batch_update_join_filter(tables: Tables):
    builders = Related(tables.customer.filter("c_mktsegment = 'BUILDING'"), {"o_custkey": "c_custkey"})
    return batch_update(tables.orders, {"o_orderstatus": "B"}, exists=[builders]).result


@query(f"""SELECT o.* REPLACE (
    CASE WHEN r.total IS NULL THEN 'N' ELSE o.o_orderstatus END AS o_orderstatus, coalesce(r.total, 0) + coalesce(l.n, 0) AS o_totalprice,
    coalesce(f.l_shipdate, o.o_orderdate) AS o_orderdate)
  FROM orders o LEFT JOIN {RETURNED} r ON r.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS l_shipdate FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) f ON f.l_orderkey = o.o_orderkey
  WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.01)
  UNION ALL SELECT o.* FROM orders o WHERE o.o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_tax > 0.01)""")
def batch_update_many_lookups(tables: Tables):
    """Two child aggregates, a look-up and an existence test on one key are met by one join."""
    returned = _returned(tables)
    lines = Aggregate("lines", tables.lineitem, {"o_orderkey": "l_orderkey"}, {"n": F.count(F.lit(1))})
    first = tables.lineitem.filter("l_linenumber = 1").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("l_shipdate"))
    taxed = Related(tables.lineitem.filter("l_tax > 0.01"), {"o_orderkey": "l_orderkey"})
    some = F.col("returned.total") != 0
    return batch_update(tables.orders, {
        "o_orderstatus": F.when(some, F.col("t.o_orderstatus")).otherwise("N"),
        "o_totalprice": child_value(returned, "total") + child_value(lines, "n"),
        "o_orderdate": F.coalesce(F.col("first.l_shipdate"), F.col("t.o_orderdate")),
    }, aggregates=[returned, lines], lookups=[Lookup("first", first, {"o_orderkey": "l_orderkey"})], exists=[taxed]).result


@query("""SELECT l.* REPLACE (CASE WHEN l_quantity < 10 AND r.k IS NOT NULL THEN 'K' ELSE l.l_returnflag END AS l_returnflag)
  FROM lineitem l LEFT JOIN (SELECT DISTINCT l_partkey AS k, l_suppkey AS v FROM lineitem WHERE l_returnflag = 'R') r
  ON r.k = l.l_partkey AND r.v = l.l_suppkey""")
def batch_update_key_list(tables: Tables):
    """A list of two-column keys selects the rows."""
    keys = tables.lineitem.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey")
    return batch_update(tables.lineitem, {"l_returnflag": "K"}, "l_quantity < 10",
                        exists=[Related(keys, {"l_partkey": "l_partkey", "l_suppkey": "l_suppkey"})]).result


@query("""SELECT * REPLACE (CASE WHEN o_orderkey IN
    (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25)
  THEN o_orderpriority || ' TOP' ELSE o_orderpriority END AS o_orderpriority) FROM orders""")
def batch_update_top_n(tables: Tables):
    return batch_update(tables.orders, {"o_orderpriority": lambda t: F.concat(t.o_orderpriority, F.lit(" TOP"))},
                        key=["o_orderkey"], order_by=[F.col("o_totalprice").desc()], limit=25).result


@query("""SELECT * REPLACE (CASE WHEN toxic = 1 THEN 'bad' WHEN quality = 0 THEN 'poor' ELSE 'good' END AS quality)
  FROM labels""")
def batch_update_converted(tables: Tables):
    """The stored text stands for a number; the literal set and the one compared are converted."""
    grade = enum_to_text({0: "poor", 1: "good", 2: "bad"})
    stored = tables.labels.withColumn("quality", grade.to_store(F.col("quality")))
    def toxic_and_graded(t):
        return (t.toxic == 1) & t.quality.isin("poor", "good") & (t.quality != grade.to_store(F.lit(2)))

    return batch_update(stored, {"quality": 2}, toxic_and_graded, converters={"quality": grade}).result


@query("SELECT l.* FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE NOT (o.o_totalprice < 50000)",
       name="cascade_delete")
def cascade_delete_lines(tables: Tables):
    gone = batch_delete(tables.orders, "o_totalprice < 50000").affected
    return cascade_delete(tables.lineitem, gone, {"l_orderkey": "o_orderkey"})
