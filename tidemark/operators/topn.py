"""The first rows in an order, whatever their number: a row is selected by counting, and a filter does the rest.

Nothing is ranked, sorted as a whole or written. A fixed number of rows, chosen by a hash, cut the order into ranges; one
pass counts the rows of each; the range that holds the wanted row is cut again. Every pass divides the rows in question by some hundreds,
so the passes grow with the logarithm of the table, and the driver holds one sample and its counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.classic.column import Column as PlanColumn

from ..functions.compare import row_digest
from ..functions.names import quote
from .lookup import repeated

#: Rows that come to the driver at once, and how many of them cut the order.
_SAMPLE, _CUTS = 4096, 255
_PASSED = "__passed"


@dataclass(frozen=True)
class _Key:
    """One column of an order."""

    column: Column
    ascending: bool
    nulls_first: bool

    def sorting(self, column: Column) -> Column:
        if self.ascending:
            return column.asc_nulls_first() if self.nulls_first else column.asc_nulls_last()
        return column.desc_nulls_first() if self.nulls_first else column.desc_nulls_last()

    def beyond(self, value: Column) -> Column:
        """Whether the row comes after ``value``."""
        c = self.column
        of_null = c.isNotNull() if self.nulls_first else F.lit(False)
        after = c > value if self.ascending else c < value
        return F.when(value.isNull(), of_null).when(c.isNull(), F.lit(not self.nulls_first)).otherwise(after)


@dataclass(frozen=True)
class Place:
    """A row in an order: its values, which of the rows with these values it is (from 1), and how many there are."""

    values: tuple
    nth: int = 1
    equal: int = 1


class Order:
    """Columns to order by, in which rows are compared with places found before.

    ``unique`` says that no two rows have the same values.
    """

    def __init__(self, df: DataFrame, columns: Sequence[Column | str], unique: bool = False):
        self.unique = unique
        jvm = df.sparkSession._jvm
        self.keys = []
        for column in (F.col(quote(c)) if isinstance(c, str) else c for c in columns):
            node = column._jc.node()
            if node.getClass().getSimpleName() == "SortOrder":
                plain = PlanColumn(jvm.org.apache.spark.sql.Column(node.child()))
                self.keys.append(_Key(plain, "Ascending" in node.sortDirection().toString(), "NullsFirst" in node.nullOrdering().toString()))
            else:
                self.keys.append(_Key(column, True, True))
        self.types = [f.dataType for f in df.select(*[k.column.alias(f"o{i}") for i, k in enumerate(self.keys)]).schema]
        for dtype in self.types:
            if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
                raise ValueError(f"rows are selected by plain values, not by {dtype.simpleString()}")

    def collected(self, df: DataFrame, n: int, by_hash: bool = False) -> list[tuple]:
        """The first ``n`` rows' values in order, or those of ``n`` rows chosen by a hash."""
        shown = [(F.unix_micros(k.column) if isinstance(t, T.TimestampType) else k.column).alias(f"o{i}") for i, (k, t) in enumerate(zip(self.keys, self.types))]
        sorting = [k.sorting(F.col(f"o{i}")) for i, k in enumerate(self.keys)]
        found = df.select(*shown)
        if by_hash:
            found = found.orderBy(F.xxhash64(*[F.col(f"o{i}") for i in range(len(self.keys))])).limit(n)
        return [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in found.orderBy(*sorting).limit(n).collect()]

    def after(self, place: Place) -> Column:
        return self._after([self.literal(v, i) for i, v in enumerate(place.values)])

    def at(self, place: Place) -> Column:
        return self._at([self.literal(v, i) for i, v in enumerate(place.values)])

    def passed(self, cuts: Sequence[tuple]) -> Column:
        """How many of the cuts, which rise, a row comes after; found by halving."""
        arrays = self._arrays(cuts)
        if not cuts:
            return F.lit(0)
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
            (n + step <= len(cuts)) & self._after([F.get(a, n + step - 1) for a in arrays]), n + step).otherwise(n))

    def _arrays(self, cuts: Sequence[tuple]) -> list[Column]:
        return [F.array(*[self.literal(c[i], i) for c in cuts]) for i in range(len(self.keys))]

    def cells(self, df: DataFrame, cuts: list[tuple]) -> DataFrame:
        """``cell, n``: rows before the first cut (0), at it (1), between it and the second (2), and so on."""
        here = (F.col(_PASSED) < len(cuts)) & self._at([F.get(a, F.col(_PASSED)) for a in self._arrays(cuts)])
        cell = 2 * F.col(_PASSED) + F.when(here, 1).otherwise(0)
        return df.withColumn(_PASSED, self.passed(cuts)).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))

    def literal(self, value, i: int) -> Column:
        """A collected value of column ``i``; timestamps travel as microseconds."""
        if isinstance(self.types[i], T.TimestampType):
            return F.timestamp_micros(F.lit(value).cast("bigint"))
        return F.lit(value).cast(self.types[i])

    def _after(self, values: Sequence[Column]) -> Column:
        test = F.lit(False)
        for key, value in reversed(list(zip(self.keys, values))):
            test = key.beyond(value) | (key.column.eqNullSafe(value) & test)
        return test

    def _at(self, values: Sequence[Column]) -> Column:
        return reduce(and_, [k.column.eqNullSafe(v) for k, v in zip(self.keys, values)])


def nth_row(df: DataFrame, order: Order, n: int) -> Place | None:
    """The ``n``-th row (from 1) of ``df``, or None if there are fewer."""
    rows, before, low, high = df, 0, None, None
    if n <= _SAMPLE // 4:  # each task keeps its first n
        first = order.collected(df, n)
        if len(first) < n:
            return None
        place = Place(first[-1], sum(v == first[-1] for v in first))
        return place if order.unique else Place(place.values, place.nth, df.filter(order.at(place)).count())
    while True:
        some = order.collected(rows, _SAMPLE, by_hash=True)
        if len(some) < _SAMPLE:  # that is all
            if before + len(some) < n:
                return None
            values = some[n - before - 1]
            return Place(values, sum(v == values for v in some[:n - before]), sum(v == values for v in some))
        cuts = list(dict.fromkeys(some[(i + 1) * _SAMPLE // (_CUTS + 1)] for i in range(_CUTS)))
        counts = {r["cell"]: r["n"] for r in order.cells(rows, cuts).collect()}
        reached = list(accumulate((counts.get(c, 0) for c in range(2 * len(cuts) + 1)), initial=before))
        cell = next((c for c in range(2 * len(cuts) + 1) if reached[c + 1] >= n), None)
        if cell is None:
            return None
        if cell % 2:
            return Place(cuts[cell // 2], n - reached[cell], counts[cell])
        low, high = (Place(cuts[cell // 2 - 1]) if cell else low), (Place(cuts[cell // 2]) if cell < 2 * len(cuts) else high)
        rows, before = df.filter(_between(order, low, high)), reached[cell]


def _between(order: Order, low: Place | None, high: Place | None) -> Column:
    """Strictly after ``low`` and before ``high``."""
    tests = [order.after(low)] if low else []
    if high:
        tests.append(~order.after(high) & ~order.at(high))
    return reduce(and_, tests, F.lit(True))


def stretch(df: DataFrame, order: Order, n: int, offset: int = 0) -> Column:
    """The test that rows ``offset + 1 .. offset + n`` of ``df`` pass, whose order must be unique."""
    if n < 0 or offset < 0:
        raise ValueError("n and offset cannot be negative")
    start, end = (nth_row(df, order, offset) if offset else None), (nth_row(df, order, offset + n) if n else None)
    if n == 0 or (offset and start is None):
        return F.lit(False)
    tests = [order.after(start)] if start else []
    return reduce(and_, [*tests, ~order.after(end)] if end else tests, F.lit(True))


def first_rows(df: DataFrame, columns: Sequence[Column | str], n: int, offset: int = 0) -> DataFrame:
    """Rows ``offset + 1 .. offset + n`` in the order of ``columns``; rows that these leave equal come in any fixed order.

    Which of them are taken is settled by a hash of the whole row; rows that are the same throughout are counted.
    """
    if n < 0 or offset < 0:
        raise ValueError("n and offset cannot be negative")
    settled = [*columns, *row_digest(df.schema, df.columns)]
    order = Order(df, settled)
    start, end = (nth_row(df, order, offset) if offset else None), (nth_row(df, order, offset + n) if n else None)
    if n == 0 or (offset and start is None):
        return df.limit(0)
    if start and end and start.values == end.values:
        return _copies(df, order, end, n)
    found = df.filter(_between(order, start, end))
    if start and start.equal > start.nth:
        found = found.union(_copies(df, order, start, start.equal - start.nth))
    if end:
        found = found.union(df.filter(order.at(end)) if end.equal == end.nth else _copies(df, order, end, end.nth))
    return found


def _copies(df: DataFrame, order: Order, place: Place, n: int) -> DataFrame:
    """``n`` of the equal rows at a place."""
    one = df.filter(order.at(place)).limit(1).withColumn("__times", F.lit(n).cast("bigint"))
    return repeated(one, "__times", [])
