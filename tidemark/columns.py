"""Which columns a merge matches on, writes, compares, updates and reports.

Pure functions of names: no session, no data, so every rule can be unit-tested.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from .spec import MergeOptions, TableSpec

#: Operations that may insert, update or delete; ``changes`` decides row by row.
INSERTING = frozenset({"insert", "insert_absent", "upsert", "sync", "changes"})
UPDATING = frozenset({"upsert", "update", "sync", "changes"})
KEY_ONLY = frozenset({"delete"})
OPERATIONS = INSERTING | UPDATING | KEY_ONLY


@dataclass(frozen=True)
class ColumnPlan:
    key: tuple[str, ...]
    null_safe: bool
    target: tuple[str, ...]
    write: tuple[str, ...]
    insert: tuple[str, ...]
    update: tuple[str, ...]
    compare: tuple[str, ...]


def _check_names(label: str, names: Sequence[str] | None, known: Sequence[str], table: str) -> None:
    unknown = sorted({n for n in names or () if n and n not in known})
    if unknown:
        raise ValueError(f"{label} of '{table}' names unknown columns: {', '.join(unknown)}")


def _either(label: str, base: Sequence[str], include, exclude, known, table: str) -> list[str]:
    """``base`` narrowed by an include list or its complement; both at once is an error."""
    if include is not None and exclude is not None:
        raise ValueError(f"include{label} and exclude{label} cannot both be set for '{table}'")
    _check_names(f"include{label}", include, known, table)
    _check_names(f"exclude{label}", exclude, known, table)
    if include is not None:
        return [c for c in base if c in include]
    if exclude is not None:
        return [c for c in base if c not in exclude]
    return list(base)


def resolve_columns(
    spec: TableSpec, options: MergeOptions, target_columns: Sequence[str], operation: str
) -> ColumnPlan:
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation '{operation}'; expected one of {sorted(OPERATIONS)}")
    table, target = spec.name, list(target_columns)

    key = tuple(options.match_on if options.match_on is not None else spec.key)
    _check_names("match_on" if options.match_on is not None else "key", key, target, table)
    if not key and operation in ("update", "delete", "changes"):
        raise ValueError(f"'{operation}' on '{table}' needs a key: declare one or pass match_on")
    null_safe = options.null_safe_keys
    if null_safe is None:
        null_safe = any(k in spec.nullable for k in key)

    version = None if options.ignore_version else spec.version
    if options.check_version and version is None:
        raise ValueError(f"check_version is set but '{table}' declares no version column")
    never_written = {version, *spec.period, *spec.computed}
    writable = [c for c in target if c not in never_written]

    include = options.include
    if include is not None:
        include = [*include, *(k for k in key if k not in include)]
    write = _either("", writable, include, options.exclude, target, table)

    if options.include_on_compare is None and options.exclude_on_compare is None:
        compare = write
    else:
        compare = _either("_on_compare", writable, options.include_on_compare,
                          options.exclude_on_compare, target, table)
    if options.include_on_update is None and options.exclude_on_update is None:
        update = [c for c in write if c not in key]
    else:
        update = _either("_on_update", writable, options.include_on_update,
                         options.exclude_on_update, target, table)
    compare = [c for c in compare if c != spec.identity]
    update = [c for c in update if c != spec.identity]
    insert = [c for c in write if options.keep_identity or c != spec.identity]

    if spec.spatial:
        if options.include_on_compare is not None or options.exclude_on_compare is not None:
            raise ValueError(f"'{table}' has spatial columns, which cannot be compared; drop the compare lists")
        compare = []
    if operation == "update" and not update:
        raise ValueError(f"'update' on '{table}' has no columns to update")

    return ColumnPlan(key, null_safe, tuple(target), tuple(write), tuple(insert), tuple(update), tuple(compare))
