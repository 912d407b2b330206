"""Few intervals that hold all keys of a list, for a scan that must not read the rest of a table.

A join cannot tell Parquet which row groups it needs; a filter on a few intervals can. The keys are counted into cells of equal width, whose
smallest and largest key come to the driver, a fixed number; the widest gaps between neighbouring cells are left out of
the intervals. A second pass counts each interval in cells of its own, which finds the gaps inside narrow clusters. The
intervals hold more than the keys, so a join or another exact test must follow.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import quote

#: Cells of a pass.
_CELLS = 1 << 14
_MEASURED = (T.IntegralType, T.DecimalType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def measure(column: Column, dtype: T.DataType) -> Column:
    """A number that rises with the column's value; distances between keys are distances of these."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column).cast("double")
    most = F.lit(1e300)
    return F.least(F.greatest(column.cast("double"), -most), most)


def _cut(cells: list, most: int) -> list[tuple]:
    """Intervals of neighbouring cells, parted at the widest gaps."""
    gaps = sorted(range(1, len(cells)), key=lambda i: cells[i - 1]["to"] - cells[i]["from_"])[:most - 1]
    starts = [0, *sorted(i for i in gaps if cells[i]["from_"] > cells[i - 1]["to"])]
    return [(cells[a], cells[b - 1]) for a, b in zip(starts, [*starts[1:], len(cells)])]


def key_intervals(keys: DataFrame, column: str, most: int = 32) -> list[tuple]:
    """At most ``most`` intervals (lowest and highest key of each, rising) that hold every value of ``column`` but NULL.

    Runs two jobs over the key column. Keys without distances, such as text, give one interval.
    """
    if most < 1:
        raise ValueError("there must be at least one interval")
    dtype = keys.schema[column].dataType
    key = F.col(quote(column))
    if not isinstance(dtype, _MEASURED):
        low, high = keys.agg(F.min(key), F.max(key)).first()
        return [] if low is None else [(low, high)]
    rows = keys.filter(key.isNotNull()).select(key.alias("k"), measure(key, dtype).alias("m"))
    first = rows.agg(F.min("k").alias("low"), F.max("k").alias("high"), F.min("m").alias("from_"), F.max("m").alias("to")).first()
    if first["low"] is None:
        return []
    found = [(first, first)]
    for _ in range(2):
        each = max(1, _CELLS // len(found))
        number = F.lit(None).cast("int")
        place = F.lit(0.0)
        for i, (a, b) in reversed(list(enumerate(found))):
            wide = max(b["to"] - a["from_"], 1e-300)
            inside = F.col("m") <= F.lit(b["to"])
            number = F.when(inside, i).otherwise(number)
            place = F.when(inside, (F.col("m") - a["from_"]) / wide).otherwise(place)
        cell = F.struct(number.alias("i"), F.least((place * each).cast("int"), F.lit(each - 1)).alias("j"))
        cells = rows.groupBy(cell.alias("cell")).agg(F.min("k").alias("low"), F.max("k").alias("high"), F.min("m").alias("from_"), F.max("m").alias("to"))
        found = _cut(sorted(cells.collect(), key=lambda r: r["cell"]), most)
    return [(a["low"], b["high"]) for a, b in found]


def within(column: Column, dtype: T.DataType, intervals: Sequence[tuple], or_null: bool = False) -> Column:
    """The test that a value lies in one of the intervals, which scans can use."""
    tests = [(column >= F.lit(low).cast(dtype)) & (column <= F.lit(high).cast(dtype)) for low, high in intervals]
    if or_null:
        tests.append(column.isNull())
    return reduce(or_, tests, F.lit(False)) if tests else F.lit(False)


def reachable(target: DataFrame, keys: DataFrame, on: Sequence[str], most: int, null_safe: bool = False) -> DataFrame:
    """``target`` without rows whose key is certainly not among ``keys``, by the first key column that has distances."""
    name = next((k for k in on if isinstance(target.schema[k].dataType, _MEASURED)), on[0])
    dtype = target.schema[name].dataType
    cast = keys.select(F.col(quote(name)).cast(dtype).alias(name))
    if keys.schema[name].dataType != dtype and not isinstance(keys.schema[name].dataType, (type(dtype), T.IntegralType)):
        return target  # the join compares in a common type, so nothing is left out here
    return target.filter(within(F.col(quote(name)), dtype, key_intervals(cast, name, most), null_safe))
