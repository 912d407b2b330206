"""The same merges run by a catalog that can change rows in place (MERGE INTO)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..columns import INSERTING, KEY_ONLY, resolve_columns
from ..functions.compare import differs
from ..functions.names import Row, as_column, as_filter
from ..spec import MergeOptions, TableSpec
from .keys import dedupe
from .merge import ORDINAL, _prepare_source


def merge_into(
    table: str,
    source: DataFrame,
    spec: TableSpec,
    operation: str = "upsert",
    options: MergeOptions | None = None,
    **settings,
) -> None:
    """Merge ``source`` into a catalog table, which rewrites only what changes.

    Takes the operations and settings of :func:`merge` (not mixed ``changes``). Identity,
    computed and default columns are left to the catalog, which generates them itself. In SQL
    text the target goes by its table name instead of ``t``. Built-in file tables do not
    support this; use :func:`merge` and publish, or :func:`merge_folder`.
    """
    options = (options or MergeOptions()).with_(**settings)
    target = source.sparkSession.table(table)
    plan = resolve_columns(spec, options, target.columns, operation)
    if operation == "changes" or not plan.key:
        raise ValueError("merge_into needs a key and one operation for all rows")
    left_out = {*spec.defaults} - {*source.columns, *(options.column_mapping or {}).values()}
    plan = replace(plan, insert=tuple(c for c in plan.insert if c not in left_out),
                   update=tuple(c for c in plan.update if c not in left_out),
                   compare=tuple(c for c in plan.compare if c not in left_out))
    rows = _prepare_source(source, target, spec, plan, options, operation in KEY_ONLY)
    if operation in KEY_ONLY:
        rows = rows.distinct()
    else:
        ordinal = [ORDINAL] if ORDINAL in rows.columns else []
        rows = dedupe(rows, plan.key, options.on_duplicate, ordinal, nulls_match=plan.null_safe)

    t, s = Row(table.split(".")[-1]), Row("s")
    match = reduce(and_, [t[k].eqNullSafe(s[k]) if plan.null_safe else t[k] == s[k] for k in plan.key])
    bump = {spec.version: t[spec.version] + 1} if spec.version and not options.ignore_version else {}
    writer = rows.alias("s").mergeInto(table, match)
    if operation == "delete":
        writer = writer.whenMatched().delete()
    elif operation != "insert_absent" and plan.update:
        tests = []
        if plan.compare and not options.always_update:
            tests.append(differs(s, t, plan.compare, target.schema))
        if options.check_version:
            tests.append(s[spec.version] == t[spec.version])
        if options.where is not None:
            tests.append(as_filter(options.where, t, s))
        matched = writer.whenMatched(reduce(and_, tests)) if tests else writer.whenMatched()
        writer = matched.update({**{c: s[c] for c in plan.update}, **bump})
    if operation in INSERTING:
        first = {spec.version: F.lit(1)} if bump else {}
        writer = writer.whenNotMatched().insert({**{c: s[c] for c in plan.insert}, **first})
    if operation == "sync":
        keep = options.delete_filter
        alone = writer.whenNotMatchedBySource() if keep is None else writer.whenNotMatchedBySource(as_filter(keep, t))
        if options.soft_delete is None:
            writer = alone.delete()
        else:
            writer = alone.update({**{c: as_column(v, t) for c, v in options.soft_delete.items()}, **bump})
    writer.merge()
