"""Differences between two copies of a table, found by digests of key ranges: what is equal is neither read again nor joined.

A table's keys are cut into ranges; a range's digest is the number of its rows and sums of two hashes of each, so it does not depend on
the order or the placing of rows, and digests of neighbouring ranges add up to that of both. The sums form a tree. Two trees over the same
cuts are compared from the root; only ranges below a differing node are compared, and only ranges that differ are read, by a filter on the
key that scans can use. Digests can be stored beside a table, so that a copy elsewhere is compared without reading the table at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..columns import resolve_columns
from ..functions.compare import row_digest
from ..functions.names import quote
from ..sources.staging import stage
from ..spec import MergeOptions, TableSpec
from .merge import _prepare_source, merge
from .topn import Order, Place

_FAN_BITS = 5
_SUMS = ("rows", "d0", "d1", "d2", "d3")
#: Rows of the sample that cuts the keys, for each range.
_PER_RANGE = 8


@dataclass(frozen=True)
class TableDigests:
    """``tree``: ``level, node, rows, d0 .. d3`` for ranges (level 0) and the sums above; ``cuts``: the last key of each range but the last."""

    key: tuple[str, ...]
    columns: tuple[str, ...]
    cuts: tuple[tuple, ...]
    tree: DataFrame

    @property
    def levels(self) -> int:
        return max(1, -(-(len(self.cuts)).bit_length() // _FAN_BITS))

    def save(self, path: str, like: DataFrame) -> None:
        """Store the digests; ``like`` gives the key's types."""
        spark = self.tree.sparkSession
        names = [f"k{i}" for i in range(len(self.key))]
        kinds = ["bigint" if isinstance(like.schema[k].dataType, T.TimestampType) else like.schema[k].dataType.simpleString() for k in self.key]
        types = ", ".join(f"{n} {kind}" for n, kind in zip(names, kinds))
        cuts = spark.createDataFrame([(i, *c) for i, c in enumerate(self.cuts)], f"place int, {types}")
        cuts.coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")
        self.tree.withColumn("of", F.array(*[F.lit(c) for c in self.columns])).write.mode("overwrite").parquet(f"{path}/tree")

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: Sequence[str]) -> "TableDigests":
        tree, cuts = spark.read.parquet(f"{path}/tree"), spark.read.parquet(f"{path}/cuts").orderBy("place")
        first = tree.select("of").first()
        return cls(tuple(key), tuple(first["of"] if first else ()), tuple(tuple(r)[1:] for r in cuts.collect()), tree.drop("of"))


def digest_table(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, ranges: int = 1024,
                 cuts: Sequence[tuple] | None = None) -> TableDigests:
    """The digests of ``df`` over ``columns`` (all) in ranges of ``key``; ``cuts`` are those of the table to compare it with.

    Two passes over the columns, one if the cuts are given. Nothing is shuffled but a row per task and range.
    """
    columns = tuple(df.columns if columns is None else columns)
    order = Order(df, list(key))
    if cuts is None:
        some = order.collected(df, ranges * _PER_RANGE, by_hash=True)
        cuts = list(dict.fromkeys(some[(i + 1) * len(some) // ranges] for i in range(ranges - 1))) if some else []
    cuts = tuple(tuple(c) for c in cuts)
    half = (1 << 32) - 1
    hashes = row_digest(df.schema, columns)
    parts = [p for h in hashes for p in (h.bitwiseAND(F.lit(half)), F.shiftright(h, 32).bitwiseAND(F.lit(half)))]
    leaves = df.select(order.passed(cuts).alias("node"), *[p.alias(f"d{i}") for i, p in enumerate(parts)])
    sums = [F.sum(c).alias(c) for c in _SUMS[1:]]
    leaves = leaves.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), *sums)
    found = TableDigests(tuple(key), columns, cuts, leaves)
    levels = F.explode(F.sequence(F.lit(0), F.lit(found.levels)))
    above = stage(leaves, "digests").withColumn("level", levels)
    node = F.expr(f"shiftright(node, {_FAN_BITS} * level)")
    tree = above.groupBy("level", node.alias("node")).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return TableDigests(tuple(key), columns, cuts, tree)


def differing_ranges(a: TableDigests, b: TableDigests) -> list[int]:
    """The numbers of the ranges whose digests differ; as many at most as there are ranges."""
    if (a.key, a.columns, a.cuts) != (b.key, b.columns, b.cuts):
        raise ValueError("digests are of other columns or ranges")
    below = None
    for level in range(a.levels, -1, -1):
        mine, theirs = (t.tree.filter(F.col("level") == level).drop("level") for t in (a, b))
        if below is not None:
            part = lambda t: t.join(below, F.shiftright("node", _FAN_BITS) == F.col("parent"), "left_semi")  # noqa: E731, B023
            mine, theirs = part(mine), part(theirs)
        both = mine.alias("a").join(theirs.alias("b"), F.col("a.node") == F.col("b.node"), "full_outer")
        same = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _SUMS])
        below = both.filter(~same).select(F.coalesce("a.node", "b.node").alias("parent"))
    return sorted(r[0] for r in below.collect())


def stretches(numbers: Sequence[int], most: int) -> list[tuple[int, int]]:
    """First and last of at most ``most`` runs that cover some range numbers; the narrowest gaps are covered too."""
    gaps = sorted((b - a for a, b in zip(numbers, numbers[1:]) if b - a > 1), reverse=True)
    widest = gaps[:most - 1]
    found = []
    for n in numbers:
        gap = n - found[-1][1] if found else None
        if gap is None or gap > 1 and gap in widest:
            if gap is not None:
                widest.remove(gap)
            found.append((n, n))
        else:
            found[-1] = found[-1][0], n
    return found


def in_ranges(df: DataFrame, digests: TableDigests, numbers: Sequence[int], most: int = 64) -> DataFrame:
    """The rows of ``df`` whose keys are in some ranges (or between them, if these are more than ``most`` runs)."""
    order, key = Order(df, list(digests.key)), F.col(quote(digests.key[0]))
    tests = []
    for first, last in stretches(numbers, most):
        low = Place(digests.cuts[first - 1]) if first else None
        high = Place(digests.cuts[last]) if last < len(digests.cuts) else None
        exact = [order.after(low)] if low else []
        exact += [~order.after(high)] if high else []
        # the same for the first key column alone, in a form that Parquet's statistics answer
        wide = []
        if low and digests.cuts[first - 1][0] is not None:
            wide.append(key >= order.literal(digests.cuts[first - 1][0], 0))
        if high and digests.cuts[last][0] is not None:
            upto = key <= order.literal(digests.cuts[last][0], 0)
            wide.append(upto if low and digests.cuts[first - 1][0] is not None else upto | key.isNull())
        tests.append(reduce(and_, [*wide, *exact], F.lit(True)))
    return df.filter(reduce(or_, tests, F.lit(False)))


def table_diff_digest(target: DataFrame, source: DataFrame, spec: TableSpec, ranges: int = 1024,
                      target_digests: TableDigests | None = None, **settings) -> DataFrame:
    """As :func:`merge.table_diff`, but ranges whose digests are equal are left out before anything is shuffled.

    Rows that are equal on both sides are no difference, also those whose key has a NULL. Hashes of 128 bits stand for rows; they are
    not made to withstand forged rows. Runs the passes of the digests; with ``target_digests`` (see :func:`digest_columns`
    for what they must be over) the target is read in the ranges that differ only.
    """
    options = MergeOptions().with_(**settings)
    plan = resolve_columns(spec, options, target.columns, "sync")
    prepared = _prepare_source(source, target, spec, plan, options, key_only=False)
    key, columns = tuple(plan.key), digest_columns(target, spec, **settings)
    if target_digests is None:
        target_digests = digest_table(target, key, columns, ranges)
    same = prepared.select(*[F.col(quote(c)).cast(target.schema[c].dataType).alias(c) for c in columns])
    numbers = differing_ranges(target_digests, digest_table(same, key, columns, cuts=target_digests.cuts))
    options = options.with_(column_mapping=None, constants=None, source_limit=None, convert=False)
    return merge(in_ranges(target, target_digests, numbers), in_ranges(prepared, target_digests, numbers), spec, "sync", options).changes


def digest_columns(target: DataFrame, spec: TableSpec, **settings) -> tuple[str, ...]:
    """The key and the columns that decide whether a row has changed, in the table's order."""
    plan = resolve_columns(spec, MergeOptions().with_(**settings), target.columns, "sync")
    return tuple(c for c in target.columns if c in plan.key or c in plan.compare)
