"""Joins of many rows to one, where some key may be very frequent on the many side.

The many side is always the left one of a left, inner, semi or anti join, whose large partitions Spark's adaptive
execution splits over several tasks while the job runs. Nothing is asked of the data beforehand, so building a plan
runs no job, and there is no bound on how many keys are frequent or how frequent they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import quote


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None where it cannot be had."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Py4JError:
        return None


def broadcast_threshold(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if text.endswith(suffix):
            return int(text[: -len(suffix)]) * units[suffix]
    return int(text)


def looks_small(df: DataFrame) -> bool:
    """Whether Spark would itself broadcast ``df``. Only chooses a plan shape, forces nothing."""
    size = estimated_bytes(df)
    return size is not None and size <= broadcast_threshold(df)


def met_by_sort(df: DataFrame) -> DataFrame:
    """Stored rows whose joins broadcast neither them nor the rows that ask for them.

    Spark takes the size of a file for that of its rows, though consecutive numbers take a hundredth there, and an exploded array for no
    larger than what it comes from; as both sides of such a join come from stored rows, either would be broadcast and fill the driver.
    Only for a side that holds each key at most once.
    """
    return df.hint("merge")


def hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(quote(c)) for c in columns])


def row_hash(df: DataFrame) -> Column:
    """A number that depends on the row alone, so a retried task computes it as before."""
    return key_hash(hashable(df))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(quote(c)).isNull() for c in columns])


def join_many_to_one(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    to: Sequence[str] | None = None,
    how: str = "left",
    null_safe: bool = False,
    aliases: tuple[str, str] = ("t", "s"),
    aliased: bool = False,
) -> DataFrame:
    """Join ``many`` to ``one``, which holds each key at most once, without a hot task.

    Sides are reached by ``aliases`` afterwards. Rows whose key is NULL match nothing unless ``null_safe``.
    ``aliased`` says that ``many`` is itself a join whose left alias is in use already.
    """
    left, right = aliases
    if not aliased:
        many = many.alias(left)
    keys = [
        F.col(quote(left, a)).eqNullSafe(F.col(quote(right, b))) if null_safe
        else F.col(quote(left, a)) == F.col(quote(right, b))
        for a, b in zip(on, to or on)
    ]
    return many.join(one.alias(right), reduce(and_, keys), how)
