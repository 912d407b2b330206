"""Null-safe row comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from .names import Row


def comparable(column: Column, dtype: T.DataType) -> Column:
    """Maps and variants have no equality in Spark: compare sorted entries, or the JSON text."""
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(column))
    if isinstance(dtype, T.VariantType):
        return F.to_json(column)
    return column


def same(left: Row, right: Row, columns: Sequence[str], schema: T.StructType) -> Column:
    """All ``columns`` equal, NULL equal to NULL (and NaN to NaN)."""
    tests = [
        comparable(left[c], schema[c].dataType).eqNullSafe(comparable(right[c], schema[c].dataType))
        for c in columns
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def differs(left: Row, right: Row, columns: Sequence[str], schema: T.StructType) -> Column:
    return ~same(left, right, columns, schema)


def row_digest(schema: T.StructType, columns: Sequence[str], row: Row | None = None) -> list[Column]:
    """Two 64-bit hashes of a row's values. Unlike Spark's hash functions they tell in which columns the NULLs are."""
    row = row or Row()

    def hashed(name: str) -> Column:
        dtype, value = schema[name].dataType, row[name]
        if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(F.struct(comparable(value, dtype).alias("v")), {"ignoreNullFields": "false"})
        return comparable(value, dtype)

    flags = [row[c].isNull() for c in columns]
    return [F.xxhash64(F.lit(seed), *flags, *[hashed(c) for c in columns]) for seed in (0, 1)]
