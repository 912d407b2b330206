"""Several row types in one table, or one row type over several tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.names import quote


def with_type(df: DataFrame, type_name: str, column: str = "Discriminator") -> DataFrame:
    """Stamp the rows with the type they belong to, for a table shared by several types."""
    return df.withColumn(column, F.lit(type_name))


def rows_of_type(table: DataFrame, *type_names: str, column: str = "Discriminator") -> DataFrame:
    """The rows of the given types in a shared table."""
    return table.filter(F.col(quote(column)).isin(*type_names))


def split_types(df: DataFrame, key: Sequence[str], base: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One wide row as a row of the base table and one of the derived table, sharing the key."""
    key, base = list(key), [c for c in base if c not in key]
    derived = [c for c in df.columns if c not in key and c not in base]
    names = lambda columns: [F.col(quote(c)) for c in columns]
    return df.select(*names(key + base)), df.select(*names(key + derived))


def union_types(*frames: DataFrame) -> DataFrame:
    """Rows of all derived types under the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
