"""Updates and deletes by predicate, with look-ups, child aggregates and top-n."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property, reduce
from operator import and_
from uuid import UUID

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.defaults import EMPTY_UUID
from ..functions.names import Row, as_column, as_filter, as_predicate, quote
from ..spec import Converter, Value
from .keys import dedupe
from .skew import any_null, join_many_to_one
from .topn import Order, stretch

_HIT, _STRETCH = "__hit", "__stretch"


@dataclass(frozen=True)
class Lookup:
    """The one row of ``table`` a target row refers to; ``on`` maps target to table columns.

    Expressions reach it as ``name.column``. Unless ``unique`` (say, by a declared key), the
    table's key is checked while the job runs.
    """

    name: str
    table: DataFrame
    on: Mapping[str, str]
    unique: bool = False


@dataclass(frozen=True)
class Aggregate:
    """Aggregates over the child rows of a target row; ``on`` maps target to child columns.

    ``values`` names aggregate columns, reached as ``name.value`` in predicates and assignments; no
    target column may have that ``name``. A target row without child rows (after ``where``) gets ``empty``
    instead, of the value's type; the default stands for 0 in numbers and NULL in other types.
    """

    name: str
    table: DataFrame
    on: Mapping[str, str]
    values: Mapping[str, Column]
    where: object = None
    empty: object = 0

    def filled(self, value: Column, dtype: T.DataType) -> Column:
        if self.empty is None or (self.empty == 0 and not isinstance(dtype, T.NumericType)):
            return value
        return F.coalesce(value, F.lit(self.empty).cast(dtype))


@dataclass(frozen=True)
class Related:
    """Rows of ``table`` whose existence decides whether a target row is affected."""

    table: DataFrame
    on: Mapping[str, str]


class BatchResult:
    """The table afterwards, the rows affected, and (one row) how many those were."""

    def __init__(self, result: Callable[[], DataFrame], affected: Callable[[], DataFrame]):
        self._result, self._affected = result, affected

    @cached_property
    def result(self) -> DataFrame:
        return self._result()

    @cached_property
    def affected(self) -> DataFrame:
        return self._affected()

    @property
    def affected_count(self) -> DataFrame:
        return self.affected.agg(F.count(F.lit(1)).alias("affected"))


@dataclass(frozen=True)
class Scope:
    """Which target rows a batch operation affects.

    ``where`` is SQL text, a ``Column`` or a function of the target row; NULL counts as
    false. ``exists``/``not_exists`` require or forbid related rows. ``order_by`` (over the
    target's columns) with ``limit``/``offset`` then takes a stretch of what is left, ``key``
    breaking ties; an order without a limit changes nothing.
    """

    where: object = None
    lookups: Sequence[Lookup] = ()
    aggregates: Sequence[Aggregate] = ()
    exists: Sequence[Related] = ()
    not_exists: Sequence[Related] = ()
    key: Sequence[str] = ()
    order_by: Sequence[Column | str] = ()
    limit: int | None = None
    offset: int = 0

    def __post_init__(self):
        if (self.limit is not None or self.offset) and not (self.order_by and self.key):
            raise ValueError("limit and offset need order_by and a unique key as tie-break")


def _keys(on: Mapping[str, str]) -> list[Column]:
    """The related side's key under names of its own, so that bare names mean the target's."""
    return [F.col(quote(c)).alias(f"__k{i}") for i, c in enumerate(on.values())]


def _by_columns(target: DataFrame, scope: Scope) -> list[list]:
    """Lookups, aggregates and related tables, those on the same target columns together."""
    groups: dict[object, list] = {}
    for relation in (*scope.lookups, *scope.aggregates, *scope.exists, *scope.not_exists):
        named = isinstance(relation, Lookup) and relation.name in target.columns  # reached by its alias alone
        groups.setdefault(id(relation) if named else tuple(sorted(relation.on)), []).append(relation)
    return list(groups.values())


def _star(df: DataFrame, relations: Sequence, exists: dict[int, str]) -> DataFrame:
    """``df`` with what several relations on the same columns have for a row, met by one left join.

    Each relation's rows are tagged by columns of their own and united; a key is then one row with the values of all. That row is
    grouped by the key as a struct and joined by its fields: the shuffle in between lets Spark split a frequent key of ``df``. The
    relations hold a key once each by then, so it is shuffled first; to combine before would only hold all of it in memory.
    """
    columns = sorted(relations[0].on)
    keys = [f"k{i}" for i in range(len(columns))]
    parts, reduced, there = [], [], []
    for i, relation in enumerate(relations):
        key = [F.col(quote(relation.on[c])).alias(k) for c, k in zip(columns, keys)]
        if isinstance(relation, Aggregate):
            rows = relation.table if relation.where is None else relation.table.filter(as_filter(relation.where, Row()))
            one = rows.groupBy(*key).agg(*[v.alias(f"__{i}_{n}") for n, v in relation.values.items()])
        elif isinstance(relation, Lookup):
            one = relation.table.select(*key, *[F.col(quote(c)).alias(f"__{i}_{c}") for c in relation.table.columns], F.lit(1).alias(f"__{i}__n"))
        else:
            one = relation.table.select(*key, F.lit(1).alias(f"__{i}__n")).distinct()
        one = one.filter(~any_null(keys))
        parts.append(one)
        for field in one.schema[len(keys):]:
            c = F.col(quote(field.name))
            if field.name == f"__{i}__n":
                reduced.append(F.count(c).alias(field.name))
            elif isinstance(field.dataType, (T.MapType, T.VariantType)):
                reduced.append(F.first(c, ignorenulls=True).alias(field.name))
            else:
                reduced.append(F.max(c).alias(field.name))
        if isinstance(relation, Lookup) and not relation.unique:
            text = F.concat(F.lit(f"more than one source row for key ({', '.join(relation.on.values())}) = "), F.col("__key").cast("string"))
            there.append(F.when(F.col(f"__{i}__n") > 1, F.raise_error(text).cast("boolean")).otherwise(True))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    star = united.withColumn("__key", F.struct(*keys)).drop(*keys).repartition("__key").groupBy("__key").agg(*reduced)
    star = reduce(lambda s, test: s.filter(test), there, star)
    name = f"__star_{'_'.join(columns)}"
    on = reduce(and_, [F.col(quote("t", c)) == F.col(quote(name, "__key", k)) for c, k in zip(columns, keys)])
    types = {f.name: f.dataType for f in star.schema}
    df = df.join(star.alias(name), on, "left")
    for i, relation in enumerate(relations):
        of = lambda n: F.col(quote(name, f"__{i}_{n}"))  # noqa: E731, B023
        if isinstance(relation, Aggregate):  # over no child rows an aggregate is empty, not NULL, in predicates as in assignments
            df = df.withColumn(relation.name, F.struct(*[relation.filled(of(n), types[f"__{i}_{n}"]).alias(n) for n in relation.values]))
        elif isinstance(relation, Lookup):
            df = df.withColumn(relation.name, F.struct(*[of(c).alias(c) for c in relation.table.columns]))
        else:
            df = df.withColumn(exists[id(relation)], F.coalesce(of("_n") > 0, F.lit(False)))
    return df


def _hits(target: DataFrame, scope: Scope) -> DataFrame:
    """The target with its related values joined on (as ``t``, ...) and ``__hit`` for the predicates."""
    t = Row("t")
    clash = sorted({a.name for a in scope.aggregates} & {*target.columns})
    if clash:
        raise ValueError(f"aggregates are named like columns of the target: {', '.join(clash)}")
    df = target.alias("t")
    related = {id(r): f"__related{i}" for i, r in enumerate((*scope.exists, *scope.not_exists))}
    for group in _by_columns(target, scope):
        if len(group) > 1:
            df = _star(df, group, related)
            continue
        [one] = group
        if isinstance(one, Lookup):
            to = list(one.on.values())
            table = one.table if one.unique else dedupe(one.table.filter(~any_null(to)), to)
            df = join_many_to_one(df, table, list(one.on), to, aliases=("t", one.name), aliased=True)
        elif isinstance(one, Aggregate):
            rows = one.table if one.where is None else one.table.filter(as_filter(one.where, Row()))
            values = rows.groupBy(*_keys(one.on)).agg(*[v.alias(k) for k, v in one.values.items()])
            raw = f"__of_{one.name}"
            df = join_many_to_one(df, values, list(one.on), values.columns[:len(one.on)], aliases=("t", raw), aliased=True)
            # over no child rows an aggregate is empty, not NULL, in predicates as in assignments
            filled = [one.filled(F.col(quote(raw, v)), values.schema[v].dataType).alias(v) for v in one.values]
            df = df.withColumn(one.name, F.struct(*filled))
        else:
            name = related[id(one)]
            keys = one.table.select(*_keys(one.on)).distinct().withColumn("__there", F.lit(True))
            df = join_many_to_one(df, keys, list(one.on), keys.columns[:-1], aliases=("t", f"{name}_of"), aliased=True)
            df = df.withColumn(name, F.col(quote(f"{name}_of", "__there")).isNotNull())
    tests = [as_predicate(scope.where, t)] if scope.where is not None else []
    tests += [F.col(related[id(r)]) for r in scope.exists] + [~F.col(related[id(r)]) for r in scope.not_exists]
    return df.withColumn(_HIT, reduce(and_, tests, F.lit(True)))


def _marked(target: DataFrame, scope: Scope) -> DataFrame:
    """As :func:`_hits`, with ``__hit`` narrowed to the stretch taken by limit and offset."""
    t = Row("t")
    if scope.limit is None and not scope.offset:
        return _hits(target, scope)
    order = [t[c] if isinstance(c, str) else c for c in scope.order_by]
    order += [t[k].asc() for k in scope.key]
    limit = scope.limit if scope.limit is not None else (1 << 62)
    candidates = _hits(_in_reach(target, scope), scope).filter(_HIT)
    candidates = candidates.select(*[t[c] for c in target.columns]).alias("t")
    within = stretch(candidates, Order(candidates, order, unique=True), limit, scope.offset)
    marked = _hits(target.alias("t").withColumn(_STRETCH, within), scope)
    return marked.withColumn(_HIT, F.col(_HIT) & t[_STRETCH])


def _in_reach(target: DataFrame, scope: Scope) -> DataFrame:
    """The target less rows that ``where`` rules out by the row alone: a filter scans can use."""
    if scope.where is None or scope.lookups or scope.aggregates:
        return target
    return target.alias("t").filter(as_filter(scope.where, Row("t")))


def batch_delete(target: DataFrame, where=None, **scope) -> BatchResult:
    """Remove the rows in scope (see :class:`Scope` for the settings)."""
    wanted = Scope(where=where, **scope)
    columns = [F.col(quote("t", c)) for c in target.columns]
    return BatchResult(
        lambda: _marked(target, wanted).filter(~F.col(_HIT)).select(*columns),
        lambda: _marked(_in_reach(target, wanted), wanted).filter(_HIT).select(*columns),
    )


def changed_values(values: Mapping[str, object], update_columns: Sequence[str] | None = None) -> dict[str, object]:
    """Of an object's values, those worth assigning: not their type's default, or forced."""

    def is_default(v) -> bool:
        if v is None or (isinstance(v, (bool, int, float, Decimal)) and v == 0):
            return True
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=None) == dt.datetime.min
        return v in (dt.date.min, dt.time.min, UUID(EMPTY_UUID)) if isinstance(v, (dt.date, dt.time, UUID)) else False

    forced = set(update_columns or ())
    unknown = sorted(forced - set(values))
    if unknown:
        raise ValueError(f"update_columns names columns without a value: {', '.join(unknown)}")
    chosen = {c: v for c, v in values.items() if c in forced or not is_default(v)}
    if not chosen:
        raise ValueError("nothing to set; name columns in update_columns to set them to their default")
    return chosen


def batch_update(
    target: DataFrame,
    set: Mapping[str, Value],
    where=None,
    converters: Mapping[str, Converter] | None = None,
    **scope,
) -> BatchResult:
    """Assign ``set`` on the rows in scope (see :class:`Scope` for the settings).

    Values are literals (passed through ``converters``), functions of the target row, or
    ``Column`` expressions over ``t.column`` and ``lookup.column``. All see the old row. A
    predicate on a converted column compares stored values: ``converter.to_store(lit(x))``.
    """
    if not set:
        raise ValueError("nothing to set")
    unknown = sorted({*set} - {*target.columns})
    if unknown:
        raise ValueError(f"set names unknown columns: {', '.join(unknown)}")
    wanted = Scope(where=where, **scope)
    t = Row("t")

    def new_value(name: str) -> Column:
        value = set[name]
        plain = not isinstance(value, Column) and not callable(value)
        column = as_column(value, t)
        if plain and converters and name in converters:
            column = converters[name].to_store(column)
        return column.cast(target.schema[name].dataType)

    columns = [
        F.when(F.col(_HIT), new_value(c)).otherwise(t[c]).alias(c) if c in set else t[c] for c in target.columns
    ]
    return BatchResult(
        lambda: _marked(target, wanted).select(*columns),
        lambda: _marked(_in_reach(target, wanted), wanted).filter(_HIT).select(*columns),
    )


def child_value(aggregate: Aggregate, value: str) -> Column:
    """An aggregate's value, ``empty`` standing in where there are no child rows."""
    return F.col(quote(aggregate.name, value))
