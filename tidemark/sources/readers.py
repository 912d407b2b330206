"""Where source rows come from, and the adjustments made before they reach an operator."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.names import Row, as_filter, quote
from ..spec import TableSpec


def from_rows(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    """A list of rows held by the program. The schema is given, never inferred.

    The rows travel as one Arrow table, which Spark knows the size of: a short list can then
    be sent to the target's rows, where a list of Python objects counts as unknown and huge.
    """
    schema = spark.createDataFrame([], schema).schema
    records = [r if isinstance(r, Mapping) else dict(zip(schema.names, r)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(schema)), schema)


def from_reader(spark: SparkSession, format: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """Rows from any Spark reader (parquet, orc, csv, json, jdbc, ...)."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def from_table(spark: SparkSession, name: str, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """A table or view as the source, with ``{source column: target column}`` renames."""
    return rename_columns(spark.table(name), mapping or {})


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    missing = sorted(set(mapping) - set(df.columns))
    if missing:
        raise ValueError(f"column mapping names unknown source columns: {', '.join(missing)}")
    return df.withColumnsRenamed(dict(mapping))


def source_limit(df: DataFrame, n: int, ordinal: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``ordinal``; an order is required, or the choice would be arbitrary."""
    from ..operators.topn import first_rows

    ordinals = [ordinal] if isinstance(ordinal, str) else list(ordinal or ())
    if not ordinals:
        raise ValueError("source_limit needs an ordinal")
    return first_rows(df, [F.col(quote(c)).asc() for c in ordinals], n)


def scoped(df: DataFrame, spec: TableSpec, ignore_row_filter: bool = False) -> DataFrame:
    """Apply the table's row filter."""
    if spec.row_filter is None or ignore_row_filter:
        return df
    return df.filter(as_filter(spec.row_filter, Row()))
