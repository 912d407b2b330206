"""Nested structs to flat columns and back, and structs kept as JSON text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .names import quote


def _leaves(schema: T.StructType, path: tuple[str, ...], keep: frozenset[str]) -> Iterator[tuple[str, ...]]:
    for f in schema.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType) and ".".join(here) not in keep:
            yield from _leaves(f.dataType, here, keep)
        else:
            yield here


def _selected(dotted: str, names: Sequence[str]) -> bool:
    return any(dotted == n or dotted.startswith(n + ".") for n in names)


def flatten_columns(
    df: DataFrame,
    names: Mapping[str, str] | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    separator: str = "_",
) -> DataFrame:
    """Every struct field, at any depth, as a column ``Owner_Child_Field``.

    ``names`` renames single leaves and ``include``/``exclude`` choose them, all by dotted
    path (a struct's path stands for everything below it). Structs in ``keep`` stay whole,
    e.g. those living in their own table. A NULL struct gives NULL fields.
    """
    if include is not None and exclude is not None:
        raise ValueError("include and exclude cannot both be set")
    out = []
    for path in _leaves(df.schema, (), frozenset(keep)):
        dotted = ".".join(path)
        if include is not None and not _selected(dotted, include):
            continue
        if exclude is not None and _selected(dotted, exclude):
            continue
        out.append(F.col(quote(*path)).alias((names or {}).get(dotted, separator.join(path))))
    return df.select(*out)


def nest_columns(df: DataFrame, layout: Mapping[str, object], null_when_empty: bool = True) -> DataFrame:
    """The inverse: ``{'owner': {'name': 'owner_name', 'home': {...}}}`` builds nested structs.

    A value is a flat column name or another layout. With ``null_when_empty`` a struct whose
    leaves are all NULL becomes NULL, so flattening and nesting undo each other.
    """

    def leaf_names(node) -> list[str]:
        return [node] if isinstance(node, str) else [n for v in node.values() for n in leaf_names(v)]

    def build(node) -> Column:
        if isinstance(node, str):
            return F.col(quote(node))
        struct = F.struct(*[build(v).alias(k) for k, v in node.items()])
        if not null_when_empty:
            return struct
        return F.when(reduce(or_, [F.col(quote(n)).isNotNull() for n in leaf_names(node)]), struct)

    used = {n for v in layout.values() for n in leaf_names(v)}
    rest = [F.col(quote(c)) for c in df.columns if c not in used]
    return df.select(*rest, *[build(v).alias(k) for k, v in layout.items()])


def json_column(df: DataFrame, *names: str) -> DataFrame:
    """Keep struct, array or map columns as JSON text. Other columns are left alone."""
    return df.withColumns({n: F.to_json(F.col(quote(n))) for n in names})


def parse_json_column(df: DataFrame, schemas: Mapping[str, str | T.DataType]) -> DataFrame:
    return df.withColumns({n: F.from_json(F.col(quote(n)), s) for n, s in schemas.items()})


def parent_key(df: DataFrame, reference: str, key: str, column: str | None = None) -> DataFrame:
    """A foreign-key column taken from a nested referenced row, which is then dropped."""
    column = column or f"{reference}_{key}"
    return df.withColumn(column, F.col(quote(reference, key))).drop(reference)


def with_srid(df: DataFrame, geometry: str, srid: int = 4326) -> DataFrame:
    """Spatial values travel as well-known bytes with their reference system beside them."""
    return df.withColumn(f"{geometry}_srid", F.when(F.col(quote(geometry)).isNotNull(), F.lit(srid)))
