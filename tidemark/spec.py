"""What a table looks like and how a merge should treat it.

Nothing here touches data: a :class:`TableSpec` is declared once per table, a
:class:`MergeOptions` once per call, and both are turned into column lists by
:func:`tidemark.columns.resolve_columns`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any, NamedTuple

from pyspark.sql import Column

#: A predicate over the target row ``t`` and the source row ``s``: either a
#: function of two row accessors or SQL text using the aliases ``t`` and ``s``.
Predicate = Callable[..., Column] | str
#: A new value for a column: a Python literal, a ``Column`` or a function of the row.
Value = Any


class Converter(NamedTuple):
    """How a column is stored: ``to_store`` on write, ``from_store`` on read."""

    to_store: Callable[[Column], Column]
    from_store: Callable[[Column], Column]


@dataclass(frozen=True)
class TableSpec:
    """The declared model of one table.

    ``nullable`` names the columns that may hold NULL. Parquet reads every column as
    nullable, so this has to be declared; a nullable key column makes the match
    null-safe. ``converters`` apply to the columns they name on the way in.
    """

    name: str
    key: tuple[str, ...] = ()
    nullable: frozenset[str] = frozenset()
    identity: str | None = None
    version: str | None = None
    defaults: Mapping[str, Value] = field(default_factory=dict)
    computed: Mapping[str, Column | str] = field(default_factory=dict)
    period: tuple[str, ...] = ()
    spatial: tuple[str, ...] = ()
    converters: Mapping[str, Converter] = field(default_factory=dict)
    row_filter: Column | str | None = None


@dataclass(frozen=True)
class MergeOptions:
    """Per-call settings of a merge.

    Column lists
        ``include``/``exclude`` choose the columns written at all, the ``*_on_compare``
        pair those that decide whether a matched row changed, the ``*_on_update`` pair
        those assigned when it did. ``include_on_update=[]`` assigns nothing, which turns
        an upsert into insert-if-absent.
    Matching
        ``match_on`` replaces the key; ``null_safe_keys`` overrides what the spec's
        nullability implies; ``on_duplicate`` says what happens when the source holds a
        key twice: ``error`` (while the job runs), ``first``/``last`` by ``ordinal``, or
        ``unchecked`` when the caller knows it cannot happen.
    Updating
        ``always_update`` writes matched rows even when nothing differs; ``where`` adds a
        condition on matched rows; ``check_version`` requires equal versions.
    Sync
        ``delete_filter`` limits which target-only rows are removed; ``soft_delete`` gives
        assignments to make instead of removing them.
    Plan
        ``strategy`` is ``auto``, ``outer`` (one full outer join) or ``split`` (a left join
        plus an anti join) or ``bitmap`` (rows whose key is not in a bitmap of ``bitmap_bits`` bits, made
        of the source's keys, pass without a shuffle; for a source of some millions of keys and a much larger table);
        ``join_hint`` is passed to Spark on the source side. ``key_intervals`` is how many intervals of
        the source's keys a delete may use to find its rows in the files (0: none).
    """

    include: Sequence[str] | None = None
    exclude: Sequence[str] | None = None
    include_on_compare: Sequence[str] | None = None
    exclude_on_compare: Sequence[str] | None = None
    include_on_update: Sequence[str] | None = None
    exclude_on_update: Sequence[str] | None = None
    match_on: Sequence[str] | None = None
    null_safe_keys: bool | None = None
    on_duplicate: str = "error"
    ordinal: str | Sequence[str] | None = None
    always_update: bool = False
    where: Predicate | None = None
    check_version: bool = False
    ignore_version: bool = False
    keep_identity: bool = False
    delete_filter: Callable[..., Column] | str | None = None
    soft_delete: Mapping[str, Value] | None = None
    column_mapping: Mapping[str, str] | None = None
    constants: Mapping[str, Value] | None = None
    use_defaults: str = "when_all_default"
    convert: bool = False
    strict: bool = False
    source_limit: int | None = None
    as_of: Column | None = None
    strategy: str = "auto"
    bitmap_bits: int = 1 << 25
    key_intervals: int = 0
    join_hint: str | None = None

    def with_(self, **changes) -> "MergeOptions":
        return replace(self, **changes)

    def ordinals(self) -> list[str]:
        if self.ordinal is None:
            return []
        return [self.ordinal] if isinstance(self.ordinal, str) else list(self.ordinal)
