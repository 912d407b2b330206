"""The default value of a type, and whether a column holds it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

# The defaults of the value types. A string or a binary column has none but NULL.
EMPTY_UUID = "00000000-0000-0000-0000-000000000000"
FIRST_DAY = "0001-01-01"


def type_default(dtype: T.DataType, uuid: bool = False) -> Column | None:
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(FIRST_DAY).cast(dtype)
    if isinstance(dtype, T.TimeType):
        return F.lit(dt.time(0, 0))
    if uuid and isinstance(dtype, T.StringType):
        return F.lit(EMPTY_UUID)
    return None


def is_type_default(column: Column, dtype: T.DataType, uuid: bool = False) -> Column:
    """True for NULL, 0, false, the first day and (if ``uuid``) the empty uuid; false for ``''``."""
    default = type_default(dtype, uuid)
    if default is None:
        return column.isNull()
    return column.isNull() | (column == default)
