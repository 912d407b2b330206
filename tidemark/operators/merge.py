"""Keyed merges: insert-if-absent, upsert, update, delete, sync and mixed change rows.

A merge is a plan from two DataFrames to one *classified* DataFrame: every row of the new
table plus every removed row, each with the action that touched it (``I``, ``U``, ``D`` or
NULL). The new table, the change feed and the statistics are views of it.

Two plan shapes give the same rows. ``outer`` joins both sides once, shuffling each once.
``split`` left-joins the target to the source and adds the source rows that found no partner;
with a small source Spark broadcasts it and the target is never shuffled, and with a match
key that repeats in the target the left join can spread frequent keys. ``bitmap`` first sets the target's
rows apart that cannot have a partner, and joins the rest in one of these shapes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..columns import INSERTING, KEY_ONLY, ColumnPlan, resolve_columns
from ..functions.compare import differs
from ..functions.convert import convert_columns
from ..functions.defaults import is_type_default
from ..functions.names import Row, as_column, as_predicate, quote
from ..sources.readers import rename_columns, source_limit
from ..sources.staging import stage
from ..spec import MergeOptions, TableSpec
from .bitmap import in_bitmap, key_bitmap
from .identity import assign_identity
from .intervals import reachable
from .keys import dedupe
from .skew import any_null, estimated_bytes, join_many_to_one, looks_small, row_hash

ACTION = "__action"
ORDINAL = "__ordinal"
FROM_SOURCE = "__from_source"
_IN_T, _IN_S, _OP, _DROP = "__in_target", "__in_source", "__op", "__drop"


@dataclass(frozen=True)
class MergeResult:
    """The outcome of a merge. Everything is lazy; :meth:`staged` evaluates it once."""

    classified: DataFrame
    source: DataFrame
    spec: TableSpec
    plan: ColumnPlan
    removes: bool = True
    _conflicts: Callable[[], DataFrame] | None = None
    _result: DataFrame | None = None

    @property
    def result(self) -> DataFrame:
        """The table after the merge."""
        if self._result is not None:
            return self._result
        rows = self.classified
        if self.removes:
            rows = rows.filter(F.col(ACTION).isNull() | (F.col(ACTION) != "D"))
        return rows.select(*self._columns())

    @property
    def changes(self) -> DataFrame:
        """The rows touched with their action; new values, or the last ones of a removed row."""
        return self.classified.filter(F.col(ACTION).isNotNull()).select(ACTION, *self._columns())

    @property
    def stats(self) -> DataFrame:
        """One row: inserted, updated, deleted."""
        return self.classified.agg(
            F.count_if(F.col(ACTION) == "I").alias("inserted"),
            F.count_if(F.col(ACTION) == "U").alias("updated"),
            F.count_if(F.col(ACTION) == "D").alias("deleted"),
        )

    @property
    def conflicts(self) -> DataFrame:
        """Matched rows left alone because their version differs: key, both versions."""
        if self._conflicts is None:
            raise ValueError(f"'{self.spec.name}' was merged without check_version")
        return self._conflicts()

    @property
    def skipped(self) -> DataFrame:
        """One row: source rows, rows output, and the difference (for whatever reason)."""
        output = self.classified.agg(
            F.count_if(F.col(ACTION).isNotNull() & F.col(FROM_SOURCE)).alias("output_rows")
        )
        total = self.source.agg(F.count(F.lit(1)).alias("n"))
        rows = total.scalar().alias("input_rows")
        return output.select(rows, "output_rows", (total.scalar() - F.col("output_rows")).alias("skipped"))

    def loaded_back(self, columns: str = "all") -> DataFrame:
        """The source rows as the table now holds them, with generated and computed values.

        ``columns`` is ``all``, ``identity`` (key and identity only) or ``included`` (those
        written). The source's ordinal comes along as ``__ordinal`` when one was given.
        """
        wanted = list(self.plan.target)
        if columns == "identity":
            wanted = [c for c in wanted if c in self.plan.key or c == self.spec.identity]
        elif columns == "included":
            wanted = [c for c in wanted if c in self.plan.write or c == self.spec.identity]
        elif columns != "all":
            raise ValueError(f"columns must be all, identity or included, not '{columns}'")
        extra = [ORDINAL] if ORDINAL in self.classified.columns else []
        return self.classified.filter(F.col(FROM_SOURCE)).select(*extra, *[F.col(quote(c)) for c in wanted])

    def output(self) -> DataFrame:
        """The change feed in key order, without rows that have no key."""
        key = [F.col(quote(k)) for k in self.plan.key]
        return self.changes.filter(key[0].isNotNull()).orderBy(*key)

    def counted(self) -> tuple[DataFrame, Observation]:
        """The new table, and the statistics as known once it has been written."""
        seen = Observation()
        counts = {"inserted": "I", "updated": "U", "deleted": "D"}
        rows = self.classified.observe(seen, *[F.count_if(F.col(ACTION) == a).alias(n) for n, a in counts.items()])
        if self.removes:
            rows = rows.filter(F.col(ACTION).isNull() | (F.col(ACTION) != "D"))
        return rows.select(*self._columns()), seen

    def staged(self, path: str | None = None) -> "MergeResult":
        """Evaluate the merge once, into shared storage, for several readers."""
        return replace(self, classified=stage(self.classified, "merge", path))

    def post_process(self, hook: Callable[[DataFrame], object]) -> object:
        """Run ``hook`` on the change feed, e.g. to write an audit log."""
        return hook(self.changes)

    def _columns(self) -> list[Column]:
        return [F.col(quote(c)) for c in self.plan.target]


# --- preparing the source -------------------------------------------------------------


def _prepare_source(source: DataFrame, target: DataFrame, spec: TableSpec, plan: ColumnPlan,
                    options: MergeOptions, key_only: bool) -> DataFrame:
    if options.column_mapping:
        source = rename_columns(source, options.column_mapping)
    if options.source_limit:
        source = source_limit(source, options.source_limit, options.ordinals())
    if options.constants:
        source = source.withColumns({c: as_column(v, Row()) for c, v in options.constants.items()})
    extra = [c for c in source.columns if c not in plan.target and c not in options.ordinals() and c != _OP]
    if extra and options.strict:
        raise ValueError(f"source columns not in '{spec.name}': {', '.join(extra)}")
    if options.convert:
        source = convert_columns(source, spec.converters)

    needed = set(plan.key) if key_only else {*plan.key, *plan.insert, *plan.update, *plan.compare}
    if options.check_version:
        needed.add(spec.version)
    missing = sorted(needed - set(source.columns) - set(spec.defaults))
    if missing:
        raise ValueError(f"source of '{spec.name}' lacks columns: {', '.join(missing)}")

    columns = []
    for field in target.schema:  # store assignment: the source takes the target's types
        if field.name in source.columns and (not key_only or field.name in plan.key):
            column = F.col(quote(field.name))
            if source.schema[field.name].dataType != field.dataType:
                column = column.cast(field.dataType)
            columns.append(column.alias(field.name))
        elif field.name in needed:  # a declared default stands in for an absent column
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    ordinals = options.ordinals()
    if ordinals and not key_only:
        order = F.col(quote(ordinals[0])) if len(ordinals) == 1 else F.struct(*[F.col(quote(c)) for c in ordinals])
        columns.append(order.alias(ORDINAL))
    if _OP in source.columns:
        columns.append(F.col(_OP))
        known = F.coalesce(F.col(_OP).isin("I", "U", "D"), F.lit(False))
        text = F.concat(F.lit(f"a change row of '{spec.name}' is marked neither I, U nor D but "), F.coalesce(F.col(_OP), F.lit("NULL")))
        source = source.filter(F.when(known, True).otherwise(F.raise_error(text).cast("boolean")))
    if not key_only:  # predicates may look at columns the target does not have
        columns += [F.col(quote(c)) for c in extra]
    return source.select(*columns)


def _has_no_identity(spec: TableSpec, plan: ColumnPlan, schema: T.StructType) -> Column | None:
    """Whether a row of a table keyed by its generated identity is new: the key is NULL or zero."""
    if plan.key == (spec.identity,):
        return is_type_default(F.col(quote(spec.identity)), schema[spec.identity].dataType)
    return None


# --- classification -------------------------------------------------------------------


def _flags(operation: str, s: Row) -> tuple[Column, Column, Column]:
    """May this source row insert, update, delete?"""
    yes, no = F.lit(True), F.lit(False)
    if operation == "changes":
        return tuple(s[_OP] == code for code in ("I", "U", "D"))
    return (
        yes if operation in INSERTING else no,
        yes if operation in ("upsert", "update", "sync") else no,
        yes if operation == "delete" else no,
    )


def _unless(bad: Column, message: str, key: tuple[str, ...], row: Row) -> Column:
    """A test that holds, or fails the job with the key. As a filter it cannot be optimised away."""
    values = F.concat_ws(", ", *[F.coalesce(row[k].cast("string"), F.lit("NULL")) for k in key])
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{message} ("), values, F.lit(")"))).cast("boolean")).otherwise(True)


def _defaults_on_insert(spec: TableSpec, plan: ColumnPlan, options: MergeOptions, source: DataFrame,
                        s: Row) -> dict[str, Column]:
    """Insert values of the columns that have a declared default."""
    out = {}
    for name, default in spec.defaults.items():
        value = as_column(default, s)
        if name not in plan.insert:
            out[name] = value
            continue
        dtype = source.schema[name].dataType
        unset = is_type_default(s[name], dtype)
        if options.use_defaults == "when_all_default":
            any_set = F.max(~is_type_default(F.col(quote(name)), dtype))
            all_unset = ~F.coalesce(source.agg(any_set.alias("any_set")).scalar(), F.lit(False))
            out[name] = F.when(all_unset, value).otherwise(s[name])
        elif options.use_defaults == "when_default":
            out[name] = F.when(unset, value).otherwise(s[name])
        elif options.use_defaults == "when_null":
            out[name] = F.coalesce(s[name], value)
        else:
            raise ValueError("use_defaults must be when_all_default, when_default or when_null, "
                             f"not '{options.use_defaults}'")
    return out


def _classify(joined: DataFrame, spec: TableSpec, plan: ColumnPlan, options: MergeOptions, operation: str,
              schema: T.StructType, source: DataFrame) -> DataFrame:
    """Decide each joined row's action, then each column's new value."""
    t, s = Row("t"), Row("s")
    in_t, in_s = t[_IN_T].isNotNull(), s[_IN_S].isNotNull()
    may_insert, may_update, may_delete = _flags(operation, s)

    update = in_t & in_s & may_update if plan.update else F.lit(False)
    if plan.update and plan.compare and not options.always_update:
        update = update & differs(s, t, plan.compare, schema)
    if options.check_version:
        update = update & F.coalesce(s[spec.version] == t[spec.version], F.lit(False))
    if options.where is not None:
        update = update & as_predicate(options.where, t, s)

    action = F.when(update, "U").when(~in_t & in_s & may_insert, "I").when(in_t & in_s & may_delete, "D")
    if operation == "sync":
        drop = in_t & ~in_s
        if options.delete_filter is not None:
            drop = drop & t[_DROP]
        action = action.when(drop, "U" if options.soft_delete is not None else "D")

    acted = joined.withColumn(ACTION, action)
    is_u, is_i = F.col(ACTION) == "U", F.col(ACTION) == "I"
    on_insert = _defaults_on_insert(spec, plan, options, source, s)
    soft = options.soft_delete or {}
    values = []
    for field in schema:
        name, dtype = field.name, field.dataType
        old = t[name]
        value = None

        def when(test: Column, new: Column) -> None:
            nonlocal value
            new = new.cast(dtype)
            value = F.when(test, new) if value is None else value.when(test, new)

        if operation == "sync" and name in soft:
            when(is_u & ~in_s, as_column(soft[name], t))
        if name in plan.update:
            when(is_u & in_s, s[name])
        if name == spec.version and not options.ignore_version:
            when(is_u, old + 1)
            when(is_i, F.lit(1))
        elif name in spec.period[:1] and options.as_of is not None:
            when(is_u | is_i, options.as_of)  # a row version starts now
        if operation in INSERTING:
            if name in on_insert:
                when(is_i, on_insert[name])
            elif name in plan.insert or name in plan.key:
                when(is_i, s[name])
        values.append((value.otherwise(old) if value is not None else old).alias(name))
    extra = [s[ORDINAL].alias(ORDINAL)] if ORDINAL in source.columns else []
    if operation == "changes":  # e.g. an update of a row that is not there
        acted = acted.filter(in_t | F.col(ACTION).isNotNull())
        acted = acted.filter(_unless(in_t & in_s & (s[_OP] == "I"), f"'{spec.name}' already has a row to be inserted, for key", plan.key, s))
    elif operation == "insert":
        acted = acted.filter(_unless(in_t & in_s, f"'{spec.name}' already has a row for key", plan.key, s))
    return acted.select(F.col(ACTION), in_s.alias(FROM_SOURCE), *extra, *values)


def _compute(classified: DataFrame, spec: TableSpec) -> DataFrame:
    """Computed columns of the rows written; they see the row's new values."""
    if not spec.computed:
        return classified
    written = F.col(ACTION).isin("I", "U")
    return classified.withColumns({
        c: F.when(written, (F.expr(e) if isinstance(e, str) else e).cast(classified.schema[c].dataType))
        .otherwise(F.col(quote(c)))
        for c, e in spec.computed.items()
    })


# --- the merge ------------------------------------------------------------------------


def merge(
    target: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    operation: str = "upsert",
    options: MergeOptions | None = None,
    **settings,
) -> MergeResult:
    """Merge ``source`` into ``target`` by key.

    ``operation`` is ``insert_absent``, ``upsert``, ``update``, ``delete``, ``sync`` (upsert
    and remove what the source lacks) or ``changes`` (the source's ``__op`` column says I, U
    or D per row). ``settings`` are fields of :class:`MergeOptions`.
    """
    options = (options or MergeOptions()).with_(**settings)
    schema = target.schema
    plan = resolve_columns(spec, options, target.columns, operation)
    key_only = operation in KEY_ONLY
    given = {*source.columns, *(options.column_mapping or {}).values(), *(options.constants or {})}
    absent_defaults = {c for c in spec.defaults if c not in given}
    if absent_defaults:  # a column the source does not carry is filled on insert, never updated
        plan = replace(plan, update=tuple(c for c in plan.update if c not in absent_defaults),
                       compare=tuple(c for c in plan.compare if c not in absent_defaults))
    unknown = sorted(set(options.soft_delete or ()) - set(target.columns))
    if unknown:
        raise ValueError(f"soft_delete of '{spec.name}' names unknown columns: {', '.join(unknown)}")
    prepared = _prepare_source(source, target, spec, plan, options, key_only)
    if key_only:
        return _delete(target, prepared, spec, plan, options)

    generated = operation in INSERTING and spec.identity in target.columns and not options.keep_identity
    fresh_rows = _has_no_identity(spec, plan, schema) if generated else None
    if ORDINAL in prepared.columns:
        order = [ORDINAL]
    else:  # any order will do, but it must spread the rows
        order = [row_hash(prepared)] if fresh_rows is not None or not plan.key else list(plan.key)
    # Rows that cannot have a partner take no part in duplicate checks or joins.
    loose = None
    if not plan.key:
        loose, keyed = prepared, prepared.limit(0)
    elif fresh_rows is not None:
        loose, keyed = prepared.filter(fresh_rows), prepared.filter(~fresh_rows)
    elif not plan.null_safe and any(prepared.schema[k].nullable for k in plan.key):
        loose, keyed = prepared.filter(any_null(plan.key)), prepared.filter(~any_null(plan.key))
    else:
        keyed = prepared
    if plan.key:
        on_order = [ORDINAL] if ORDINAL in keyed.columns else options.ordinals()
        keyed = dedupe(keyed, plan.key, options.on_duplicate, on_order)
    if options.join_hint:
        keyed = keyed.hint(options.join_hint)

    if operation == "sync" and options.delete_filter is not None:
        target = target.withColumn(_DROP, as_predicate(options.delete_filter, Row()))
    whole = target
    tagged_t = target.withColumn(_IN_T, F.lit(True))
    tagged_s = keyed.withColumn(_IN_S, F.lit(True))

    def classify(joined: DataFrame) -> DataFrame:
        return _classify(joined, spec, plan, options, operation, schema, prepared)

    def unmatched_target(df: DataFrame) -> DataFrame:
        nothing = tagged_s.limit(0)
        return df.alias("t").join(nothing.alias("s"), F.lit(False), "left")

    inserts = operation in INSERTING
    apart = None
    if options.strategy == "bitmap" and plan.key:
        known = key_bitmap(keyed.select(*[F.col(quote(k)) for k in plan.key]), plan.key, options.bitmap_bits)
        target, apart = in_bitmap(target, known, plan.key, options.bitmap_bits)
        tagged_t = target.withColumn(_IN_T, F.lit(True))
    unique_in_target = tuple(plan.key) == tuple(spec.key)
    shape = options.strategy
    if shape in ("auto", "bitmap"):
        shape = "split" if not unique_in_target or _much_smaller(keyed, target) else "outer"
    if shape not in ("outer", "split"):
        raise ValueError(f"strategy must be auto, outer, split or bitmap, not '{options.strategy}'")

    if not plan.key:
        classified = classify(unmatched_target(tagged_t))
        new = prepared
    elif operation == "insert_absent":
        new = _without_partner(keyed, target, plan, unique_in_target, spec.identity)
        new = new if loose is None else new.unionByName(loose)
        classified = classify(unmatched_target(tagged_t))
    elif shape == "outer" and inserts and not generated:
        on = _match(plan)
        classified = classify(tagged_t.alias("t").join(tagged_s.alias("s"), on, "full_outer"))
        new = loose if loose is None or operation != "changes" else loose.filter(F.col(_OP) == "I")
    else:
        joined = join_many_to_one(tagged_t, tagged_s, plan.key, null_safe=plan.null_safe)
        classified = classify(joined)
        new = None
        if inserts:
            may_insert = keyed.filter(F.col(_OP) == "I") if operation == "changes" else keyed
            new = _without_partner(may_insert, target, plan, unique_in_target, spec.identity)
            if loose is not None:
                new = new.unionByName(loose.filter(F.col(_OP) == "I") if operation == "changes" else loose)
    if new is not None:
        if generated:
            new = assign_identity(new, spec.identity, order, whole.agg(F.max(quote(spec.identity))).scalar())
            plan_new = replace(plan, insert=(*plan.insert, spec.identity))
        else:
            plan_new = plan
        absent = target.limit(0).withColumn(_IN_T, F.lit(True))
        alone = new.withColumn(_IN_S, F.lit(True)).alias("s").join(absent.alias("t"), F.lit(False), "left")
        fresh = _classify(alone, spec, plan_new, options, operation, schema, prepared)
        classified = classified.unionByName(fresh)
    if apart is not None:
        classified = classified.unionByName(classify(unmatched_target(apart.withColumn(_IN_T, F.lit(True)))))
    classified = _compute(classified, spec)

    conflicts = None
    if options.check_version:
        def conflicts() -> DataFrame:
            t, s = Row("t"), Row("s")
            pairs = join_many_to_one(target, keyed, plan.key, how="inner", null_safe=plan.null_safe)
            differ = ~F.coalesce(t[spec.version] == s[spec.version], F.lit(False))
            return pairs.filter(differ).select(
                *[t[k].alias(k) for k in plan.key],
                t[spec.version].alias("target_version"), s[spec.version].alias("source_version"),
            )
    removes = operation == "changes" or (operation == "sync" and options.soft_delete is None)
    return MergeResult(classified, prepared, spec, plan, removes, conflicts)


def _much_smaller(source: DataFrame, target: DataFrame) -> bool:
    """Whether sending the source to the target's rows beats shuffling both."""
    if not looks_small(source):
        return False
    size = estimated_bytes(target)
    return size is None or size > 8 * estimated_bytes(source)


def _match(plan: ColumnPlan) -> Column:
    t, s = Row("t"), Row("s")
    return reduce(and_, [t[k].eqNullSafe(s[k]) if plan.null_safe else t[k] == s[k] for k in plan.key])


def _without_partner(source: DataFrame, target: DataFrame, plan: ColumnPlan, unique: bool,
                     identity: str | None) -> DataFrame:
    """Source rows whose key the target lacks; only the target's key columns are read.

    A small source is first sent to the target to find which of its keys exist, so the
    target's keys are not shuffled; the answer is no larger than the source.
    """
    keys = target.select(*[F.col(quote(k)) for k in plan.key])
    if looks_small(source):
        keys = keys.alias("t").join(source.select(*keys.columns).alias("s"), _match(plan), "left_semi")
    if not unique:
        keys = keys.distinct()  # a frequent key becomes one row before the shuffle
    if plan.key != (identity,):
        return source.alias("s").join(keys.alias("t"), _match(plan), "left_anti")
    # New rows often carry a constant as their identity. Catalyst keeps moving an anti join on a
    # constant to and fro until it gives up, so this one is an outer join.
    known = keys.withColumn(_IN_T, F.lit(True)).alias("t")
    joined = source.alias("s").join(known, _match(plan), "left")
    return joined.filter(Row("t")[_IN_T].isNull()).select(*[Row("s")[c] for c in source.columns])


def _delete(target: DataFrame, keys: DataFrame, spec: TableSpec, plan: ColumnPlan,
            options: MergeOptions, unique: bool = False) -> MergeResult:
    """Rows whose key the source names go; a semi and an anti join on the key columns alone.

    Keys that are ``unique`` already are not held in memory once more to make them so.
    """
    keys = keys if unique else keys.distinct()
    if options.join_hint:
        keys = keys.hint(options.join_hint)

    def side(how: str) -> DataFrame:
        joined = join_many_to_one(target, keys, plan.key, how=how, null_safe=plan.null_safe)
        return joined.select(*[F.col(quote(c)) for c in target.columns])

    if options.strategy == "bitmap":
        whole = target
        target, apart = in_bitmap(target, key_bitmap(keys, plan.key, options.bitmap_bits), plan.key, options.bitmap_bits)
        kept = side("left_anti").union(apart)
        target = target if not options.key_intervals else whole
    else:
        kept = side("left_anti")
    if options.key_intervals:  # the removed rows are found without reading all of the table
        target = reachable(target, keys, plan.key, options.key_intervals, plan.null_safe)
    gone = side("left_semi")
    changes = gone.select(F.lit("D").alias(ACTION), F.lit(True).alias(FROM_SOURCE), *gone.columns)
    rest = kept.select(F.lit(None).cast("string").alias(ACTION), F.lit(False).alias(FROM_SOURCE), *kept.columns)
    return _DeleteResult(rest.unionByName(changes), keys, spec, plan, _result=kept, gone=changes)


@dataclass(frozen=True)
class _DeleteResult(MergeResult):
    """A delete knows its removed rows without looking at the others."""

    gone: DataFrame | None = None

    @property
    def changes(self) -> DataFrame:
        return self.gone.drop(FROM_SOURCE)

    @property
    def stats(self) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        return self.gone.agg(zero.alias("inserted"), zero.alias("updated"), F.count(F.lit(1)).alias("deleted"))

    def staged(self, path: str | None = None) -> MergeResult:
        both = stage(self.classified, "delete", path)
        is_gone = F.col(ACTION).isNotNull()
        return replace(self, classified=both, gone=both.filter(is_gone),
                       _result=both.filter(~is_gone).drop(ACTION, FROM_SOURCE))


# --- plain inserts and differences ----------------------------------------------------


def append_rows(target: DataFrame, source: DataFrame, spec: TableSpec, **settings) -> DataFrame:
    """The target with the source's rows added; no key is looked at.

    With an identity column and ``keep_identity=False`` new rows are numbered by ``ordinal``.
    """
    keyless = replace(spec, key=())
    return merge(target, source, keyless, "insert_absent", **settings).result


def insert(target: DataFrame, source: DataFrame, spec: TableSpec, on_conflict: str = "error",
           **settings) -> DataFrame:
    """Insert with a rule for keys the table already has.

    ``error`` fails while the job runs, ``ignore`` keeps the old row, ``replace`` puts the new
    one in its place.
    """
    if on_conflict == "ignore":
        return merge(target, source, spec, "insert_absent", **settings).result
    if on_conflict == "replace":
        options = MergeOptions(**settings)
        plan = resolve_columns(spec, options, target.columns, "upsert")
        new = _prepare_source(source, target, spec, plan, options, key_only=False)
        new = dedupe(new, plan.key, options.on_duplicate, [ORDINAL] if ORDINAL in new.columns else [])
        keys = new.select(*[F.col(quote(k)) for k in plan.key])
        unique = options.on_duplicate != "unchecked"
        kept = _delete(target, keys, spec, plan, MergeOptions(match_on=options.match_on), unique).result
        new = new.drop(ORDINAL)
        return append_rows(kept, new, spec, include=new.columns, keep_identity=True)
    if on_conflict != "error":
        raise ValueError(f"on_conflict must be error, ignore or replace, not '{on_conflict}'")
    return merge(target, source, spec, "insert", **settings).result


def table_diff(target: DataFrame, source: DataFrame, spec: TableSpec, **settings) -> DataFrame:
    """What it takes to turn ``target`` into ``source``, as rows with ``__action``."""
    return merge(target, source, spec, "sync", **settings).changes
