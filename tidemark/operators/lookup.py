"""Keyed reads: fetch the rows of a table for a (large) list of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arithmetic import int_divide
from ..functions.convert import convert_columns
from ..functions.names import Row, quote
from ..sources.readers import scoped
from ..spec import TableSpec
from .intervals import reachable
from .keys import dedupe
from .skew import join_many_to_one, looks_small

#: A repeated row is produced in blocks, so that no array grows with the number of copies.
_BLOCK = 4096


def lookup(
    source: DataFrame,
    target: DataFrame,
    spec: TableSpec,
    mode: str = "enrich",
    match_on: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    first_by: Sequence[str] | None = None,
    duplicates: str = "keep",
    null_safe: bool | None = None,
    ignore_row_filter: bool = False,
    convert: bool = False,
    key_intervals: int = 0,
) -> DataFrame:
    """Read ``target`` by the keys in ``source``.

    ``enrich`` returns every source row, its columns replaced by those of the matching target
    row; rows without a match stay as they are. Where a key matches several target rows the
    first by ``first_by`` is used. ``replace`` returns the matching target rows themselves, as
    often as their key was asked for (``duplicates='keep'``) or once (``'drop'``).
    ``columns`` limits what is loaded; the key always comes along. With ``key_intervals`` the keys are first covered
    by so many intervals, which the scan uses to skip files and row groups (two jobs over the keys).
    """
    key = list(match_on or spec.key)
    unknown = sorted(set(key) - set(target.columns))
    if unknown:
        raise ValueError(f"match_on of '{spec.name}' names unknown columns: {', '.join(unknown)}")
    if not key:
        raise ValueError(f"a lookup in '{spec.name}' needs a key")
    if null_safe is None:
        null_safe = any(k in spec.nullable for k in key)
    if convert:
        source = convert_columns(source, {k: v for k, v in spec.converters.items() if k in key})
    target = scoped(target, spec, ignore_row_filter)
    if key_intervals:
        target = reachable(target, source, key, key_intervals, null_safe)
    wanted = [c for c in target.columns if columns is None or c in columns or c in key]
    unique = tuple(key) == tuple(spec.key)
    if mode == "replace":
        return _replace(source, target.select(*[F.col(quote(c)) for c in wanted]), key, duplicates, null_safe)
    if mode != "enrich":
        raise ValueError(f"mode must be enrich or replace, not '{mode}'")

    order = list(first_by or ())
    needed = [*wanted, *(c for c in order if c not in wanted)]
    found = target.select(*[F.col(quote(c)) for c in needed])
    if looks_small(source):  # read the table once past the keys; no more rows survive than match
        found = join_many_to_one(found, source.select(*[F.col(quote(k)) for k in key]).distinct(), key,
                                 how="left_semi", null_safe=null_safe).select(*needed)
    if not unique:
        found = dedupe(found, key, "first" if order else "error", order)
    found = found.withColumn("__found", F.lit(True))
    s, t = Row("s"), Row("t")
    joined = join_many_to_one(source, found, key, null_safe=null_safe, aliases=("s", "t"))
    hit = t["__found"]
    out = [F.when(hit, t[c]).otherwise(s[c]).alias(c) if c in wanted else s[c] for c in source.columns]
    out += [t[c].alias(c) for c in wanted if c not in source.columns]
    return joined.select(*out)


def _replace(source: DataFrame, target: DataFrame, key: list[str], duplicates: str, null_safe: bool) -> DataFrame:
    keys = [F.col(quote(k)) for k in key]
    if duplicates == "drop":
        once = source.select(*keys).distinct()
        joined = join_many_to_one(target, once, key, how="left_semi", null_safe=null_safe)
        return joined.select(*[F.col(quote("t", c)) for c in target.columns])
    if duplicates != "keep":
        raise ValueError(f"duplicates must be keep or drop, not '{duplicates}'")
    # Requests are counted per key first, so a key asked for often is one row in the join.
    asked = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__asked"))
    joined = join_many_to_one(target, asked, key, how="inner", null_safe=null_safe)
    rows = joined.select(*[F.col(quote("t", c)) for c in target.columns], F.col(quote("s", "__asked")).alias("__n"))
    return repeated(rows, "__n", keys).select(*[F.col(quote(c)) for c in target.columns])


def repeated(rows: DataFrame, count: str, apart: Sequence[Column]) -> DataFrame:
    """Each row as often as its ``count`` says; ``apart`` tells rows apart.

    Rows asked for more than a block's worth are cut into blocks (in two steps, so that no array is long), which
    are dealt out again: else one task would have to make all copies of a row.
    """
    n = F.col(quote(count))
    often = rows.filter(n > _BLOCK)
    zero, tasks = F.lit(0).cast("bigint"), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for step in (_BLOCK * _BLOCK, _BLOCK):
        last = int_divide(n - 1, F.lit(step))
        often = often.withColumn("__part", F.explode(F.sequence(zero, last)))
        often = often.withColumn(count, F.least(F.lit(step).cast("bigint"), n - F.col("__part") * step))
        often = often.repartition(tasks, *apart, "__part").drop("__part")  # a fixed number: the rows are few and small as yet
    both = rows.filter(n <= _BLOCK).union(often)
    return both.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), n))).drop("__copy", count)
