"""Duplicate keys: finding, rejecting and resolving them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.names import quote
from .skew import any_null


def duplicate_keys(df: DataFrame, key: Sequence[str], count: str = "count") -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*[F.col(quote(k)) for k in key]).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def assert_unique(df: DataFrame, key: Sequence[str], samples: int = 5) -> None:
    """Raise now if ``key`` is not unique, naming a few offenders."""
    found = duplicate_keys(df, key).limit(samples).collect()
    if found:
        raise ValueError(f"key ({', '.join(key)}) is not unique, e.g. {[tuple(r) for r in found]}")


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def dedupe(
    df: DataFrame,
    key: Sequence[str],
    keep: str = "error",
    ordinal: Sequence[str] = (),
    nulls_match: bool = True,
    row_id: str | None = None,
) -> DataFrame:
    """One row per key: the ``first`` or ``last`` by ``ordinal``, or a failure on a second row.

    The check reads the keys alone: rows are sorted by key, which a merge join that follows uses as it is, and
    a second row of a key fails the job; whatever else is done with the result, the check stays in the plan. To pick
    a row is an aggregate: each task first reduces its own rows to one per key, so a key holding
    much of the data never gathers in one task. A source that is partitioned by
    ``key`` already is not shuffled again, and the result's partitioning serves a join. Equal
    ordinals are settled by the remaining columns, so a recomputed task picks the same row.
    With ``nulls_match=False`` rows with a NULL key column are all kept; a ``row_id`` column
    that tells rows apart saves a second pass for it.
    """
    if keep == "unchecked":
        return df
    if keep not in ("error", "first", "last"):
        raise ValueError(f"on_duplicate must be error, first, last or unchecked, not '{keep}'")
    if keep != "error" and not ordinal:
        raise ValueError(f"on_duplicate='{keep}' needs an ordinal")
    keys = [F.col(quote(k)) for k in key]
    if keep == "error":
        text = F.concat_ws(", ", *[F.coalesce(k.cast("string"), F.lit("NULL")) for k in keys])
        message = F.concat(F.lit(f"more than one source row for key ({', '.join(key)}) = ("), text, F.lit(")"))
        second = F.col("__place") > 1
        if not nulls_match:  # rows with a NULL match nothing and are not gathered to be numbered
            with_null = df.filter(any_null(key))
            return dedupe(df.filter(~any_null(key)), key).unionByName(with_null)
        placed = df.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
        return placed.filter(F.when(second, F.raise_error(message).cast("boolean")).otherwise(True)).drop("__place")

    apart = []
    if not nulls_match and row_id is not None:
        apart = [F.when(any_null(key), F.col(quote(row_id))).alias("__apart")]
    elif not nulls_match:
        with_null = df.filter(any_null(key))
        return dedupe(df.filter(~any_null(key)), key, keep, ordinal).unionByName(with_null)

    rest = [c for c in df.columns if c not in key]
    order = [F.col(quote(c)) for c in ordinal]
    tie = [F.col(quote(c)) for c in rest if c not in ordinal and _orderable(df.schema[c].dataType)]
    other = [F.col(quote(c)) for c in rest if not _orderable(df.schema[c].dataType)]
    ranked = F.struct(*order, *tie)
    pick = F.max_by if keep == "last" else F.min_by
    if other:
        row = pick(F.struct(*[F.col(quote(c)) for c in rest], F.lit(True).alias("__one")), ranked)
    else:
        row = (F.max if keep == "last" else F.min)(F.struct(*order, *tie, F.lit(True).alias("__one")))
    one = df.groupBy(*keys, *apart).agg(row.alias("__row"))
    columns = {c: (F.col(quote(c)) if c in key else F.col("__row").getField(c).alias(c)) for c in df.columns}
    return one.select(*[columns[c] for c in df.columns])
