"""A bounded bitmap of hashed keys, which tells rows that cannot have a partner from those that may.

Its size is fixed, whatever the number of keys: a key sets one bit of ``bits``. So it may be sent to every task, and a table is divided
without a shuffle. A row whose bit another key has set goes to the join for nothing; with as many keys as a tenth of the bits
that is every tenth row, and no result depends on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import quote

#: Fixed value: bits of one bitmap of Spark's bitmap functions.
_BITS = 32768
_MOST = 1 << 28


def _place(df: DataFrame, key: Sequence[str], bits: int) -> Column:
    def value(name: str) -> Column:
        column = F.col(quote(name))  # -0.0 equals 0.0 in a join, so it must in the hash
        return column + F.lit(0.0).cast(df.schema[name].dataType) if isinstance(df.schema[name].dataType, T.FractionalType) and not isinstance(
            df.schema[name].dataType, T.DecimalType) else column

    return F.pmod(F.xxhash64(*[value(k) for k in key]), F.lit(bits))


def key_bitmap(keys: DataFrame, key: Sequence[str], bits: int = 1 << 25) -> DataFrame:
    """``__bucket, __bitmap``: ``bits`` bits of the hashed keys, in pieces of 4 KB; pieces without a key are left out."""
    if not _BITS <= bits <= _MOST:
        raise ValueError(f"a bitmap has {_BITS} to {_MOST} bits, not {bits}")
    place = keys.select(_place(keys, key, bits).alias("place"))
    return place.groupBy(F.expr(f"place div {_BITS}").alias("__bucket")).agg(F.bitmap_construct_agg(F.col("place") % _BITS).alias("__bitmap"))


def in_bitmap(df: DataFrame, bitmap: DataFrame, key: Sequence[str], bits: int = 1 << 25) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key may be in the bitmap, and those whose key is not. Each reads ``df`` once and shuffles nothing."""
    columns = [F.col(quote(c)) for c in df.columns]
    # the pieces have a fixed size in all, an eighth of the bits, so they may be sent to all tasks
    met = df.withColumn("__at", _place(df, key, bits)).join(F.broadcast(bitmap), F.expr(f"__at div {_BITS}") == F.col("__bucket"), "left")
    at = F.col("__at") % _BITS
    byte = F.conv(F.hex(F.substr("__bitmap", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return met.filter(held).select(*columns), met.filter(~held).select(*columns)
