"""Change sets over several tables: rows marked I, U or D, applied in foreign-key order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.names import quote
from ..sources.staging import stage
from ..spec import TableSpec
from .keys import dedupe
from .merge import _OP, ORDINAL, MergeResult, merge
from .skew import join_many_to_one, met_by_sort
from .tree import ancestry


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` refers to the single key column of ``parent``.

    Where that key is generated, ``reference`` names the column of the child's change rows
    that holds the ordinal of the parent's change row.
    """

    child: str
    column: str
    parent: str
    reference: str | None = None


def table_groups(names: Iterable[str], foreign_keys: Iterable[ForeignKey]) -> list[list[str]]:
    """Tables that refer to each other in a circle together, each group after those it refers to."""
    parents: dict[str, list[str]] = {n: [] for n in names}
    for fk in foreign_keys:
        if fk.child in parents and fk.parent in parents and fk.child != fk.parent:
            parents[fk.child].append(fk.parent)
    number: dict[str, int] = {}
    reach: dict[str, int] = {}
    open_: list[str] = []
    groups: list[list[str]] = []

    def visit(name: str) -> None:
        number[name] = reach[name] = len(number)
        open_.append(name)
        for parent in parents[name]:
            if parent not in number:
                visit(parent)
            if parent in open_:
                reach[name] = min(reach[name], reach[parent])
        if reach[name] == number[name]:  # the first of its group to be met
            at = open_.index(name)
            groups.append(open_[at:])
            del open_[at:]

    for name in parents:
        if name not in number:
            visit(name)
    return [sorted(g, key=list(parents).index) for g in groups]


def topological_order(names: Iterable[str], foreign_keys: Iterable[ForeignKey]) -> list[str]:
    """Table names, parents before children; tables that refer to each other in a circle follow each other."""
    return [name for group in table_groups(names, foreign_keys) for name in group]


def apply_changes(
    targets: Mapping[str, DataFrame],
    changes: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    foreign_keys: Iterable[ForeignKey] = (),
    op_column: str = "op",
    ordinal: Mapping[str, str] | None = None,
    **settings,
) -> dict[str, MergeResult]:
    """Apply change rows to their tables; ``op_column`` says insert, update or delete per row.

    Any other code fails the job, as does an insert of a row that is there; an update or delete of one that is not changes
    nothing. A table's three kinds of change are one merge and so one join. Tables come parents first,
    so that a child can take the key generated for its parent (``ordinal`` names, per table, the
    column that orders and identifies its change rows); publish inserts in that order
    and deletions in the reverse one (see :func:`publish_order`). Tables that refer to each other in a circle, or to themselves, are
    given their keys first and the references in a second pass; publish them together.
    """
    foreign_keys = [fk for fk in foreign_keys if fk.child in changes and fk.parent in changes]
    handed = [fk for fk in foreign_keys if fk.reference is not None]
    results: dict[str, MergeResult] = {}
    keys: dict[str, DataFrame] = {}

    def merged(name: str, rows: DataFrame) -> MergeResult:
        return merge(targets[name], rows, specs[name], "changes", ordinal=(ordinal or {}).get(name), **settings)

    for group in table_groups(changes, foreign_keys):
        inner = [fk for fk in handed if fk.child in group and fk.parent in group]
        rows = {}
        for name in group:
            rows[name] = changes[name].withColumnRenamed(op_column, _OP)
            for fk in handed:
                if fk.child == name and fk not in inner:
                    rows[name] = _take_parent_key(rows[name], fk, keys[fk.parent])
        for name in {fk.parent: None for fk in inner}:  # keys first, with the references open
            own = [fk for fk in inner if fk.child == name]
            keys[name] = met_by_sort(stage(_given_keys(merged(name, _unset(rows[name], own, targets[name]))), "keys"))
        for name in group:
            for fk in inner:
                if fk.child == name:
                    rows[name] = _take_parent_key(rows[name], fk, keys[fk.parent])
            results[name] = merged(name, rows[name])
            if name not in keys and any(fk.parent == name for fk in handed):
                keys[name] = met_by_sort(stage(_given_keys(results[name]), "keys"))
    return results


def _unset(rows: DataFrame, references: list[ForeignKey], target: DataFrame) -> DataFrame:
    """The rows as they are before they are given the keys they refer to."""
    for fk in references:
        if fk.column not in rows.columns:
            rows = rows.withColumn(fk.column, F.lit(None).cast(target.schema[fk.column].dataType))
    return rows.drop(*{fk.reference for fk in references})


def _given_keys(parent: MergeResult) -> DataFrame:
    loaded = parent.loaded_back("identity")
    if ORDINAL not in loaded.columns:
        raise ValueError(f"a reference to a key of '{parent.spec.name}' needs the ordinal of its change rows")
    given = loaded.select(F.col(ORDINAL).alias("__ref"), F.col(quote(parent.plan.key[0])).alias("__key"))
    return dedupe(given.filter("__ref IS NOT NULL"), ["__ref"])  # an ordinal that repeats names no row


def _take_parent_key(rows: DataFrame, fk: ForeignKey, keys: DataFrame) -> DataFrame:
    joined = join_many_to_one(rows, keys, [fk.reference], ["__ref"])
    columns = [c for c in rows.columns if c not in (fk.column, fk.reference)]
    old = F.col(quote("t", fk.column)) if fk.column in rows.columns else F.lit(None)
    return joined.select(*[F.col(quote("t", c)) for c in columns], F.coalesce(F.col("s.__key"), old).alias(fk.column))


def publish_order(results: Mapping[str, MergeResult], deletions: bool = False) -> list[str]:
    """Parents first; children first when only deletions are published."""
    return list(reversed(results)) if deletions else list(results)


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """The child rows left when parents are removed; ``on`` maps child to parent columns."""
    gone = deleted_parents.select(*[F.col(quote(c)) for c in on.values()]).distinct()
    joined = join_many_to_one(child, gone, list(on), list(on.values()), how="left_anti")
    return joined.select(*[F.col(quote("t", c)) for c in child.columns])


def cascade_delete_tree(df: DataFrame, key: str, parent: str, deleted: DataFrame) -> DataFrame:
    """The rows left when the rows ``deleted`` names by ``key`` go with all that lie below them, however deep.

    ``parent`` refers to ``key``. Rows in a circle, and below one, go if any row of the circle does.
    """
    gone = deleted.select(F.col(quote(key)).alias("__gone")).distinct()
    marked = df.join(gone, F.col(quote(key)) == F.col("__gone"), "left").select(
        F.col(quote(key)).alias("key"), F.col(quote(parent)).alias("parent"), F.col("__gone").isNotNull().alias("mark"))
    below = ancestry(marked, "key", "parent", "mark", circles=True).filter("marked").select(F.col("key").alias("__gone"))
    columns = [F.col(quote("t", c)) for c in df.columns]
    known = F.col(quote(key)).isNotNull()  # a row without a key is nobody's parent, but may lie below a row that goes
    kept = [join_many_to_one(part, below, [on], ["__gone"], how="left_anti").select(*columns) for part, on in ((df.filter(known), key), (df.filter(~known), parent))]
    return kept[0].union(kept[1])
