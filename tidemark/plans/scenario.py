"""Merge inputs made from the given tables, as DataFrames and as the same thing in SQL.

``stored`` is the orders table before open urgent orders arrived. ``feed`` is today's extract:
finished low-priority orders have been archived, some statuses, prices and dates amended.
Merging one into the other inserts, updates, keeps and (in a sync) removes rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..spec import TableSpec
from .registry import Tables

ORDERS = TableSpec("orders", key=("o_orderkey",))
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def stored(tables: Tables) -> DataFrame:
    return tables.orders.filter(~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")))


def feed(tables: Tables) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    date, price = F.col("o_orderdate"), F.col("o_totalprice")
    day = F.expr("INTERVAL 1 DAY")
    amended = {
        "o_orderstatus": F.when((priority == "2-HIGH") & (status == "P"), "X").otherwise(status),
        "o_totalprice": F.when(priority == "3-MEDIUM", price + 100).otherwise(price),
        "o_orderdate": F.when((priority == "4-NOT SPECIFIED") & (status == "F"), date + day)
        .when((priority == "4-NOT SPECIFIED") & (status == "O"), date - day)
        .otherwise(date),
    }
    return tables.orders.filter(~((priority == "5-LOW") & (status == "F"))).select(
        *[amended[c].alias(c) if c in amended else F.col(c) for c in COLUMNS]
    )


INPUTS = """
WITH t AS (
  SELECT * FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')
), s AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY
         WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN o_orderdate - INTERVAL 1 DAY
         ELSE o_orderdate END AS o_orderdate,
    o_orderpriority
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
)
"""
#: Some non-key column differs between a matched pair.
CHANGED = "(" + " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in COLUMNS[1:]) + ")"


def columns_of(alias: str, names: list[str] = COLUMNS) -> str:
    return ", ".join(f"{alias}.{c}" for c in names)


def assigned(test: str, names: list[str], columns: list[str] = COLUMNS) -> str:
    """The select list of an update: ``names`` from ``s`` where ``test`` holds, the rest from ``t``."""
    return ", ".join(f"CASE WHEN {test} THEN s.{c} ELSE t.{c} END AS {c}" if c in names else f"t.{c}" for c in columns)
