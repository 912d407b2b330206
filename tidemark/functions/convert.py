"""Value converters: built-in pairs, and applying a spec's converters to a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..spec import Converter
from .names import quote
from .times import epoch_micros, from_epoch_micros


def _lookup(pairs: Mapping, column: Column) -> Column:
    """A literal CASE, folded into generated code. NULL stays NULL, an unknown value fails the job."""
    out = F.when(column.isNull(), F.lit(None))
    for key, value in pairs.items():
        out = out.when(column == F.lit(key), F.lit(value))
    text = F.concat(F.lit("no member of the enumeration: "), column.cast("string"))
    return out.otherwise(F.raise_error(text))


def enum_to_text(members: Mapping[int, str]) -> Converter:
    """A number in memory, its member name in the table."""
    back = {name: number for number, name in members.items()}
    return Converter(lambda c: _lookup(members, c), lambda c: _lookup(back, c))


def enum_to_number(members: Mapping[str, int]) -> Converter:
    """A member name in memory, its number in the table."""
    back = {number: name for name, number in members.items()}
    return Converter(lambda c: _lookup(members, c), lambda c: _lookup(back, c))


#: A date kept one day ahead in the table.
ADD_ONE_DAY = Converter(
    lambda c: c + F.make_dt_interval(F.lit(1)),
    lambda c: c - F.make_dt_interval(F.lit(1)),
)
#: A whole number kept as its eight bytes, high byte first.
NUMBER_BYTES = Converter(
    lambda c: F.unhex(F.lpad(F.hex(c.cast("bigint")), 16, "0")),
    lambda c: F.conv(F.hex(c), 16, -10).cast("bigint"),
)


#: A timestamp without time zone kept as microseconds since 1970.
EPOCH_MICROS = Converter(epoch_micros, from_epoch_micros)


def convert_columns(df: DataFrame, converters: Mapping[str, Converter]) -> DataFrame:
    """Apply ``to_store`` to the columns of ``df`` that have a converter."""
    here = {c: v for c, v in converters.items() if c in df.columns}
    return df.withColumns({c: v.to_store(F.col(quote(c))) for c, v in here.items()}) if here else df


def restore_columns(df: DataFrame, converters: Mapping[str, Converter]) -> DataFrame:
    """Apply ``from_store``: the inverse of :func:`convert_columns`."""
    here = {c: v for c, v in converters.items() if c in df.columns}
    return df.withColumns({c: v.from_store(F.col(quote(c))) for c, v in here.items()}) if here else df
