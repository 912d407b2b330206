"""Column names that hold dots, brackets or back-ticks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quote(*parts: str) -> str:
    """``quote('t', 'a.b')`` gives ``` `t`.`a.b` ```, safe for ``F.col`` and SQL text."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


class Row:
    """Access to the columns of one side of a join: ``t['price']`` or ``t.price``."""

    def __init__(self, alias: str | None = None):
        self._alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(quote(self._alias, name) if self._alias else quote(name))

    def __getattr__(self, name: str) -> Column:
        if name.startswith("__"):
            raise AttributeError(name)
        return self[name]


def as_column(value, *rows: Row) -> Column:
    """A literal, a ``Column``, or a function of the given rows, as a ``Column``."""
    if isinstance(value, Column):
        return value
    if callable(value):
        return value(*rows)
    return F.lit(value)


def as_filter(value, *rows: Row) -> Column:
    """As :func:`as_column`, but text is SQL. For ``filter``, which drops NULL and can push it down."""
    return F.expr(value) if isinstance(value, str) else as_column(value, *rows)


def as_predicate(value, *rows: Row) -> Column:
    """As :func:`as_filter`, with NULL made false, so that it can be negated and combined."""
    return F.coalesce(as_filter(value, *rows), F.lit(False))
