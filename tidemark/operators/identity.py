"""Consecutive numbers over a distributed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import quote
from ..sources.staging import stage
from .skew import hashable, key_hash

RANK = "__rank"
_PLACE = "__place"
#: monotonically_increasing_id() keeps the partition above, the row number below this bit.
_ROW_BITS = 33


def rank_rows(df: DataFrame, order: Sequence[Column | str], columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``__rank`` = 1, 2, 3, ... in ``order``, without gathering the rows anywhere.

    The rows are range-partitioned, sorted per partition and written out once, together with
    their place in the partition; the few partition sizes then give each partition's offset.
    Writing first matters: places would differ if the plan ran again. ``columns`` are those to
    keep; only they are written, and a hash of them settles and spreads ties in ``order``.
    """
    names = df.columns if columns is None else list(columns)
    kept = [F.col(quote(c)) for c in names]
    order = [F.col(quote(c)) if isinstance(c, str) else c for c in order]
    ties = [c for c in hashable(df) if c in names]
    if ties:
        order.append(key_hash(ties))
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*kept, F.monotonically_increasing_id().alias(_PLACE)),
        "rank",
    )
    part = F.shiftright(F.col(_PLACE), _ROW_BITS)
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    if not sizes:
        return placed.withColumn(RANK, F.lit(None).cast("bigint")).drop(_PLACE)
    offsets, total = [], 0  # one entry per partition
    for size in sizes:
        offsets += [total] * (size["part"] + 1 - len(offsets))
        total += size["n"]
    before = F.expr(f"get(array({', '.join(f'{o}L' for o in offsets)}), int(shiftright({_PLACE}, {_ROW_BITS})))")
    return placed.withColumn(RANK, before + row + 1).drop(_PLACE)


def assign_identity(df: DataFrame, identity: str, order: Sequence[Column | str], after: Column | int) -> DataFrame:
    """Give ``identity`` the values ``after + 1, after + 2, ...`` in ``order``."""
    start = F.lit(after) if isinstance(after, int) else after
    dtype = df.schema[identity].dataType if identity in df.columns else "bigint"
    ranked = rank_rows(df, order)
    return ranked.withColumn(identity, (F.coalesce(start, F.lit(0)) + F.col(RANK)).cast(dtype)).drop(RANK)
