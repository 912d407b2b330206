"""The newest row of each key, kept in a stream's state store.

Each key's newest order values are state; a row passes only if it is newer, so what reaches a table are winners alone, and a
late row is dropped before it is joined or written. The state is checkpointed with the stream: a
restarted query goes on where it was. Rows are compared as they are: a pandas frame for each key takes milliseconds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.names import quote

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestRow(StatefulProcessor):
    """Passes a key's newest row of a batch if it is newer than all before; equal ones do not pass again.

    ``ttl_ms`` forgets keys that were not seen for so long, after which a late row would pass.
    """

    def __init__(self, order: Sequence[str], schema: T.StructType, ttl_ms: int | None = None):
        self.order, self.columns, self.ttl_ms = list(order), schema.names, ttl_ms
        self.instants = [isinstance(schema[c].dataType, T.TimestampType) for c in self.order]
        self.state_schema = T.StructType([schema[c] for c in self.order])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = newest = None
        for row in rows:  # a frequent key has many, of which one is held
            values = self._values(row[c] for c in self.order)
            if all(v is not None and v == v for v in values) and (newest is None or values > newest):  # noqa: PLR0124
                best, newest = row, values
        if best is None:
            return
        known = self.newest.get() if self.newest.exists() else None
        if known is None or newest > self._values(known):
            self.newest.update(newest)
            yield best

    def _values(self, values: Iterable) -> tuple:
        """Instants come with a zone in rows, and without one, in local time, from the store."""
        return tuple(v.astimezone(dt.timezone.utc) if instant and v is not None else v for instant, v in zip(self.instants, values))

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, key: Sequence[str], order: Sequence[str], ttl_ms: int | None = None) -> DataFrame:
    """Of each key, the rows that were the newest when they came, by ``order``; rows with a NULL in it never pass.

    With foreachBatch, or :class:`StreamedTable`, each batch then has at most one row a key. Needs the RocksDB state store (see :func:`use_state_store`).
    """
    missing = [c for c in (*key, *order) if c not in stream.columns]
    if missing:
        raise ValueError(f"the stream has no columns {', '.join(missing)}")
    grouped = stream.groupBy(*[quote(k) for k in key])
    return grouped.transformWithState(
        statefulProcessor=NewestRow(order, stream.schema, ttl_ms), outputStructType=stream.schema, outputMode="Update",
        timeMode="ProcessingTime" if ttl_ms else "None")


def use_state_store(spark: SparkSession) -> None:
    """Keep state in RocksDB, on disk, so that it may be larger than an executor's memory."""
    spark.conf.set(_STORE, _ROCKSDB)
