"""Rows that refer to rows of their own table, to any depth, by pointer doubling.

Every row points to its parent; in each round it takes the pointer of the row it points to, and what that row has gathered on its way, so that
after r rounds it knows its next 2^r ancestors. The rounds grow with the logarithm of the depth. Rows that have reached the top are
written once and not touched again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.names import quote
from ..sources.staging import stage
from .keys import dedupe
from .skew import join_many_to_one


def ancestry(df: DataFrame, key: str, parent: str, mark: str | None = None, circles: bool = False) -> DataFrame:
    """``key, root, depth, marked`` of every row that has a key.

    ``root`` is the topmost ancestor (the row's own key if it has none), ``depth`` the number of ancestors, ``marked`` whether the
    row or an ancestor has a true ``mark``. A parent that is not in the table counts as none. A key that repeats fails the job. Rows in or below a circle
    raise an error; with ``circles`` their root and depth are NULL, and they are marked if one of the rows of the circle or on the way to it is.
    A frequent parent is the key of a join's larger side, which Spark splits.
    """
    own = F.lit(False) if mark is None else F.coalesce(F.col(quote(mark)), F.lit(False))
    rows = df.filter(F.col(quote(key)).isNotNull()).select(F.col(quote(key)).alias("key"), F.col(quote(parent)).alias("up"), own.alias("marked"))
    known = dedupe(rows.select(F.col("key").alias("there")), ["there"])
    top = rows.filter("up IS NULL").withColumn("there", F.lit(None).cast(rows.schema["key"].dataType))
    met = join_many_to_one(rows.filter("up IS NOT NULL"), known, ["up"], ["there"]).select("key", "up", "marked", "there").union(top.select("key", "up", "marked", "there"))
    state = stage(met.select("key", F.col("there").alias("up"), F.coalesce("there", "key").alias("root"), F.col("there").isNotNull().cast("bigint").alias("depth"), "marked"), "tree")
    n, window = state.count(), 1
    done, active = [state.filter("up IS NULL")], state.filter("up IS NOT NULL")
    while window <= n and not active.isEmpty():
        above = reduce(DataFrame.union, [*done, active])
        joined = join_many_to_one(active, above, ["up"], ["key"])
        moved = joined.select(
            F.col("t.key").alias("key"), F.col("s.up").alias("up"), F.col("s.root").alias("root"), (F.col("t.depth") + F.col("s.depth")).alias("depth"),
            (F.col("t.marked") | F.col("s.marked")).alias("marked"))
        moved = stage(moved, "tree")
        done.append(moved.filter("up IS NULL"))
        active, window = moved.filter("up IS NOT NULL"), 2 * window
    circular = not active.isEmpty()
    if circular and not circles:
        raise ValueError(f"rows refer to each other in a circle, e.g. at {key} = {active.first()['key']}")
    if circular:  # a window as long as the table has gone round
        done.append(active.withColumns({"root": F.lit(None).cast(active.schema["root"].dataType), "depth": F.lit(None).cast("bigint")}))
    return reduce(DataFrame.union, done).select(F.col("key").alias(key), "root", "depth", "marked")
