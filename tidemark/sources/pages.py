"""A source that hands out its rows in pages, read by several tasks at once.

A service or an old system often has only "the next rows after this key". Its key range is divided among partitions; a
task asks for page after page of its part and gives each on as it comes, so no task holds more than a page. Filters on the key that
Spark pushes down narrow the range, and nothing is asked for outside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan,
                                    LessThanOrEqual)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: ``fetch(low, high, limit)`` gives at most ``limit`` rows with low <= key <= high, by rising key.
Fetch = Callable[[int, int, int], Sequence[tuple]]


@dataclass(frozen=True)
class PagedSource:
    """What is known of a source: its rows' schema, the whole-number key that pages follow, and how to get a page."""

    schema: StructType
    key: str
    fetch: Fetch
    low: int
    high: int
    partitions: int = 8
    page: int = 1000


@dataclass
class _Part(InputPartition):
    low: int
    high: int


class _PageReader(DataSourceReader):
    def __init__(self, source: PagedSource):
        self.source, self.low, self.high = source, source.low, source.high

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrow the range by what is asked of the key; anything else is left to Spark."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != (self.source.key,) or not isinstance(value, int):
                yield f
            elif isinstance(f, EqualTo):
                self.low, self.high = max(self.low, value), min(self.high, value)
            elif isinstance(f, GreaterThanOrEqual):
                self.low = max(self.low, value)
            elif isinstance(f, GreaterThan):
                self.low = max(self.low, value + 1)
            elif isinstance(f, LessThanOrEqual):
                self.high = min(self.high, value)
            elif isinstance(f, LessThan):
                self.high = min(self.high, value - 1)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        span = self.high - self.low + 1
        if span <= 0:
            return [_Part(self.low, self.low - 1)]
        n = min(self.source.partitions, span)
        cuts = [self.low + span * i // n for i in range(n + 1)]
        return [_Part(a, b - 1) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.source.schema)
        at = self.source.schema.names.index(self.source.key)
        low, limit = partition.low, self.source.page
        while low <= partition.high:
            rows = self.source.fetch(low, partition.high, limit)
            full = len(rows) >= limit
            if full:  # the last key may go on beyond the page: its rows are asked for again
                low = rows[-1][at]
                rows = [r for r in rows if r[at] != low]
                limit = self.source.page if rows else 2 * limit
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            if not full:
                return


def from_pages(spark: SparkSession, schema: StructType | str, key: str, fetch: Fetch, low: int, high: int, partitions: int = 8,
               page: int = 1000) -> DataFrame:
    """Rows of a paged source whose ``key`` lies from ``low`` to ``high``.

    ``fetch(low, high, limit)`` is called in the tasks and gives the first ``limit`` rows of a range by rising key, as tuples in the schema's order. Keys may
    repeat; rows with a NULL key are not asked for. A partition that is lost is asked for again.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if key not in schema.names:
        raise ValueError(f"the schema has no column '{key}'")
    source = PagedSource(schema, key, fetch, low, high, partitions, page)
    format_ = f"pages_{uuid.uuid4().hex}"

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_

        def schema(self) -> StructType:
            return source.schema

        def reader(self, schema: StructType) -> DataSourceReader:
            return _PageReader(source)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Pages)
    return spark.read.format(format_).load()
