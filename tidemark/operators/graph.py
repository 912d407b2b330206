"""Nested rows written to related tables, with keys handed from parents to children."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import quote
from ..sources.staging import stage
from ..spec import TableSpec
from .identity import RANK, rank_rows
from .keys import dedupe
from .merge import ORDINAL, MergeResult, merge
from .skew import any_null, join_many_to_one, met_by_sort, row_hash

ROW = "__row"
_GRAPH_OPERATIONS = {"insert_absent", "upsert", "sync", "update"}


@dataclass(frozen=True)
class Many:
    """A nested array of child rows; the child's ``foreign_key`` (a column for each of the key) takes the parent's key."""

    field: str
    node: "Node"
    foreign_key: str | tuple[str, ...]


@dataclass(frozen=True)
class One:
    """A nested row this row refers to; this row's ``foreign_key`` (a column for each of the key) takes its key."""

    field: str
    node: "Node"
    foreign_key: str | tuple[str, ...]


@dataclass(frozen=True)
class Node:
    """A table in the graph. ``match_on`` is its natural key where the key is generated."""

    spec: TableSpec
    many: tuple[Many, ...] = ()
    one: tuple[One, ...] = ()
    match_on: tuple[str, ...] | None = None

    @property
    def generated(self) -> bool:
        return self.spec.identity is not None and self.spec.key == (self.spec.identity,)

    @property
    def link(self) -> tuple[str, ...]:
        """What tells rows of this table apart before generated keys exist."""
        return self.match_on or ((ROW,) if self.generated else self.spec.key)


@dataclass(frozen=True)
class Flat:
    """One table's rows out of a graph, and which of its columns wait for a generated key."""

    node: Node
    rows: DataFrame
    pending: Mapping[str, str]


def _pending(column: str) -> str:
    return f"__link_{column}"


def _foreign(ref: Many | One, parent: Node) -> tuple[str, ...]:
    columns = (ref.foreign_key,) if isinstance(ref.foreign_key, str) else tuple(ref.foreign_key)
    if len(columns) != len(parent.spec.key):
        raise ValueError(f"the key of '{parent.spec.name}' has {len(parent.spec.key)} columns, not {len(columns)} as in '{ref.field}'")
    return columns


def _link(node: Node, row: Column, prefix: str | None = None) -> Column:
    """What a row is known by: its natural key, or its path where there is none or part of it is NULL."""
    natural = [F.col(quote(c) if prefix is None else quote(prefix, c)) for c in node.match_on or ()]
    known = reduce(and_, [c.isNotNull() for c in natural]) if natural else F.lit(False)
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(natural)], F.when(~known, row).alias("row"))


def _below(place: Column) -> Column:
    """The path of a row nested in this one."""
    return F.struct(F.col(ROW)["root"].alias("root"), F.concat(F.col(ROW)["path"], F.array(place.cast("bigint"))).alias("path"))


def flatten_graph(df: DataFrame, root: Node, ordinal: str | None = None) -> dict[str, Flat]:
    """Split nested rows into one DataFrame per table, in an order that suits their keys.

    Referenced rows come before the rows that refer to them, children after. Foreign keys are
    filled from the nested rows; where the key is still to be generated, the row keeps a link
    to its parent instead. Each row gets ``__row``, its path in the graph, which orders it (by the
    ``ordinal`` of its root, of any type, first) and identifies it, be ordinals repeated or absent. Within one evaluation, that is:
    :func:`merge_graph`, which evaluates tables one by one, numbers and stores the rows before.
    """
    if ROW not in df.columns:
        first = F.lit(None).cast("int") if ordinal is None else F.col(quote(ordinal))
        df = df.withColumn(ROW, F.struct(first.alias("root"), F.array(F.monotonically_increasing_id()).alias("path")))
    found: dict[str, list[Flat]] = {}
    order: list[str] = []

    def visit(rows: DataFrame, node: Node, pending: dict[str, str]) -> None:
        name = node.spec.name
        nested = {r.field for r in (*node.many, *node.one)}
        filled = {c for r in node.one for c in _foreign(r, r.node)}
        own = [F.col(quote(c)) for c in rows.columns if c not in nested and c not in filled]
        for place, ref in enumerate(node.one):
            to = ref.node
            inner = rows.schema[ref.field].dataType
            path = _below(F.lit(-1 - place))
            there = rows.filter(F.col(quote(ref.field)).isNotNull())
            visit(there.select(*[F.col(quote(ref.field, c)) for c in inner.names], path.alias(ROW)), to, {})
            if to.generated:
                column = _foreign(ref, to)[0]
                own.append(F.when(F.col(quote(ref.field)).isNotNull(), _link(to, path, ref.field)).alias(_pending(column)))
                pending = {**pending, column: to.spec.name}
            else:
                own += [F.col(quote(ref.field, k)).alias(c) for c, k in zip(_foreign(ref, to), to.spec.key)]
        found.setdefault(name, []).append(Flat(node, rows.select(*own), pending))
        if name not in order:
            order.append(name)
        for ref in node.many:
            child = ref.node
            inner = rows.schema[ref.field].dataType.elementType
            columns = _foreign(ref, node)
            if node.generated:
                handed = {_pending(columns[0]): _link(node, F.col(ROW))}
                waits = {columns[0]: name}
            else:
                handed = {c: F.col(quote(k)) for c, k in zip(columns, node.spec.key)}
                waits = {}
            carried = [v.alias(c) for c, v in handed.items()]
            exploded = rows.select(ROW, *carried, F.posexplode(F.col(quote(ref.field))).alias("__pos", "__child"))
            children = exploded.filter(F.col("__child").isNotNull()).select(
                *[F.col(quote("__child", c)) for c in inner.names if c not in columns],
                *[F.col(quote(c)) for c in handed], _below(F.col("__pos")).alias(ROW),
            )
            visit(children, child, waits)

    visit(df, root, {})
    return {
        name: replace(
            found[name][0],
            rows=reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.rows for f in found[name]]),
            pending={k: v for f in found[name] for k, v in f.pending.items()},
        )
        for name in order
    }


def unique_rows(rows: DataFrame, node: Node) -> DataFrame:
    """The first instance per key; rows whose key is not set are all kept."""
    return rows if node.link == (ROW,) else dedupe(rows, node.link, "first", [ROW], nulls_match=False, row_id=ROW)


def merge_graph(
    df: DataFrame,
    root: Node,
    targets: Mapping[str, DataFrame],
    operation: str = "upsert",
    ordinal: str | None = None,
    **settings,
) -> dict[str, MergeResult]:
    """Merge nested rows into their tables, parents first, and hand generated keys down.

    The nested rows are numbered in the order of ``ordinal`` and stored once, as all tables read them and generated
    keys must be the same for each. Ordinals may be of any type, repeat, or be left out.
    """
    if operation not in _GRAPH_OPERATIONS:
        raise ValueError(f"a graph can be merged with {sorted(_GRAPH_OPERATIONS)}, not '{operation}'")
    results: dict[str, MergeResult] = {}
    keys: dict[str, DataFrame] = {}
    numbered = rank_rows(df, [ordinal] if ordinal is not None else [row_hash(df)])
    path = F.struct(F.col(RANK).alias("root"), F.array(F.col(RANK).cast("bigint")).alias("path"))
    flats = flatten_graph(numbered.withColumn(ROW, path).drop(RANK), root)
    awaited = {parent for f in flats.values() for parent in f.pending.values()}

    def merged(name: str, node: Node, rows: DataFrame) -> MergeResult:
        return merge(targets[name], rows, node.spec, operation, match_on=node.match_on, ordinal=ROW,
                     on_duplicate="unchecked", **settings)

    for name, flat in flats.items():
        node, rows = flat.node, flat.rows
        for column, parent in flat.pending.items():
            if parent != name:
                rows = _resolve(rows, column, keys[parent])
        rows = unique_rows(rows, node)
        if node.generated and node.spec.identity not in rows.columns:
            rows = rows.withColumn(node.spec.identity, F.lit(None).cast("bigint"))
        own = [c for c, p in flat.pending.items() if p == name]
        if own:  # rows refer to rows of the same table: their keys first, then the references
            unset = {c: F.lit(None).cast("bigint") for c in own}
            keys[name] = _given_keys(merged(name, node, rows.withColumns(unset)), node, rows, targets[name], operation)
            for column in own:
                rows = _resolve(rows, column, keys[name])
        results[name] = merged(name, node, rows)
        if name in awaited and name not in keys:
            keys[name] = _given_keys(results[name], node, rows, targets[name], operation)
    return results


def _given_keys(result: MergeResult, node: Node, rows: DataFrame, target: DataFrame, operation: str) -> DataFrame:
    """Each row's link and the key it has now; stored, as children ask for it repeatedly."""
    key = F.col(quote(node.spec.identity)).alias("__key")
    given = result.loaded_back().select(_link(node, F.col(ORDINAL)).alias("__link"), key)
    if operation == "insert_absent":  # rows that were there already have a key as well
        match = list(node.match_on or node.spec.key)
        there = target.select(*dict.fromkeys([*match, node.spec.identity])).filter(~any_null(match))
        there = dedupe(there, match).withColumn("__key", F.col(quote(node.spec.identity)))
        known = join_many_to_one(rows, met_by_sort(there), match, how="inner", aliases=("r", "k"))
        own = known.select(*[F.col(quote("r", c)) for c in rows.columns], F.col("k.__key"))
        given = given.union(own.select(_link(node, F.col(ROW)).alias("__link"), "__key"))
    return met_by_sort(stage(given, "keys"))


def _resolve(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Replace a row's link to its parent by the parent's generated key."""
    joined = join_many_to_one(rows, keys, [_pending(column)], ["__link"])
    rest = [F.col(quote("t", c)) for c in rows.columns if c not in (_pending(column), column)]
    return joined.select(*rest, F.col("s.__key").alias(column))


def graph_stats(results: Mapping[str, MergeResult]) -> DataFrame:
    """Inserted, updated and deleted rows over all tables of a graph."""
    each = reduce(DataFrame.unionByName, [r.stats for r in results.values()])
    return each.agg(*[F.sum(c).alias(c) for c in ("inserted", "updated", "deleted")])


def fill_self_reference(
    df: DataFrame, key: str, natural_key: Sequence[str], parent: Sequence[str], foreign_key: str
) -> DataFrame:
    """Second pass over a table whose rows refer to each other by natural key.

    ``parent`` holds the natural key of the row referred to; ``foreign_key`` receives that
    row's key, or NULL where there is none. A natural key held twice fails while the job runs.
    """
    natural = [F.col(quote(c)).alias(f"__n{i}") for i, c in enumerate(natural_key)]
    known = df.select(*natural, F.col(quote(key)).alias("__key"))
    names = known.columns[:-1]
    known = dedupe(known.filter(~any_null(names)), names)  # a name with a NULL is nobody's
    joined = join_many_to_one(df, known, list(parent), names)
    rest = [F.col(quote("t", c)) for c in df.columns if c != foreign_key]
    return joined.select(*rest, F.col("s.__key").alias(foreign_key))
