"""A table kept up to date from a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from ..functions.names import quote
from ..operators.folders import merge_folder, read_folder
from ..operators.keys import dedupe
from ..sources.staging import discard, stage, stage_path
from ..spec import TableSpec

BUCKET = "__bucket"


@dataclass
class StreamedTable:
    """Upserts micro-batches into a Parquet folder split into buckets by key hash.

    A micro-batch reads and rewrites only the buckets its keys fall into. Within a batch the
    last row per key by ``ordinal`` wins; against the table, the row with the greater
    ``newer_by``, so late rows lose without a watermark. Applying a batch twice changes
    nothing, which makes a restarted query safe although ``foreachBatch`` may repeat a batch.
    ``schema`` is that of the table; ``buckets`` is fixed for its folder: see :meth:`rebucketed`.
    """

    path: str
    spec: TableSpec
    schema: str
    ordinal: Sequence[str]
    newer_by: str | None = None
    buckets: int = 64
    on_batch: Callable[[int, dict], None] | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return read_folder(spark, self.path, self._stored_schema()).drop(BUCKET)

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        """A writer over ``stream``; the caller picks its trigger and starts it."""
        return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.apply)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(quote(k)) for k in self.spec.key]), F.lit(self.buckets)).cast("int")

    def rebucketed(self, spark: SparkSession, path: str, buckets: int) -> "StreamedTable":
        """The table in a folder of its own with another number of buckets, as it grows or shrinks.

        To be called between two runs of the stream, which goes on from its checkpoint with the new table.
        """
        grown = replace(self, path=path, buckets=buckets)
        rows = self.read(spark).withColumn(BUCKET, grown._bucket())
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
        return grown

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        key = list(self.spec.key)
        latest = dedupe(batch, key, "last", list(self.ordinal)).withColumn(BUCKET, self._bucket())
        copy = stage_path(batch.sparkSession, "batch")
        latest = stage(latest, path=copy)  # read more than once below, when a batch's state would be gone through again
        where = None
        if self.newer_by is not None:
            where = lambda t, s: s[self.newer_by] > t[self.newer_by]
        merged = merge_folder(
            self.path, self._stored_schema(), latest, replace(self.spec, key=(*key, BUCKET)), [BUCKET],
            where=where, on_duplicate="unchecked", keep_identity=True, keep_staged=self.on_batch is not None,
        )
        if merged is not None and self.on_batch is not None:
            self.on_batch(batch_id, merged.stats.first().asDict())
        discard(batch.sparkSession, copy)

    def _stored_schema(self) -> str:
        return f"{self.schema}, {BUCKET} int"


def batch_progress(report: Callable[[dict], None]) -> StreamingQueryListener:
    """A listener handing each micro-batch's numbers to ``report``; add it to ``spark.streams``."""

    class Progress(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            p = event.progress
            report({"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond})

        def onQueryTerminated(self, event):
            pass

    return Progress()
