"""Update expressions whose meaning differs from Spark's bare operators.

``+ - *``, ``coalesce`` and casts are used as Spark has them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def int_divide(left: Column, right: Column) -> Column:
    """Division that stays integral (7 / 2 = 3, -7 / 2 = -3); Spark's ``/`` gives 3.5."""
    return F.call_function("div", left, right)


def concat_text(*parts: Column) -> Column:
    """String addition; NULL if any part is NULL."""
    return F.concat(*parts)


def bit_and(left: Column, right: Column) -> Column:
    return left.bitwiseAND(right)


def bit_or(left: Column, right: Column) -> Column:
    return left.bitwiseOR(right)


def bit_xor(left: Column, right: Column) -> Column:
    return left.bitwiseXOR(right)


def bit_not(column: Column, dtype: T.DataType) -> Column:
    """Logical NOT of a boolean, bitwise complement of an integer."""
    return ~column if isinstance(dtype, T.BooleanType) else F.bitwise_not(column)
