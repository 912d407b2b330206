"""Merging into a partitioned Parquet folder, touching only the partitions concerned."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import quote
from ..sources.publish import publish_partitions
from ..sources.readers import rename_columns
from ..sources.staging import discard, stage_path
from ..spec import MergeOptions, TableSpec
from .merge import ACTION, MergeResult, merge


def read_folder(spark: SparkSession, path: str, schema) -> DataFrame:
    """The folder's rows; none if it does not exist yet."""
    empty = spark.createDataFrame([], schema)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return empty
    stored = spark.read.schema(empty.schema).parquet(path)
    return stored.select(*[F.col(quote(c)) for c in empty.columns])


def _only(stored: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, bool]:
    """The rows in some partitions, and whether there are any such partitions.

    Their values come to the driver, which lists the folder's partitions anyway. A list of values per column prunes
    the read; where there are several columns, a join leaves out the combinations that were not asked for.
    """
    wanted = partitions.select(*[F.col(quote(c)) for c in columns]).distinct()
    found = wanted.collect()
    for c in columns:
        column, values = F.col(quote(c)), {r[c] for r in found}
        test = column.isin([v for v in values if v is not None])
        stored = stored.filter(test | column.isNull() if None in values else test)
    if len(columns) > 1:
        on = reduce(and_, [F.col(quote("t", c)).eqNullSafe(F.col(quote("p", c))) for c in columns])
        stored = stored.alias("t").join(wanted.alias("p"), on, "left_semi")
    return stored, bool(found)


def merge_folder(
    path: str,
    schema,
    source: DataFrame,
    spec: TableSpec,
    partition_by: Sequence[str],
    operation: str = "upsert",
    options: MergeOptions | None = None,
    keep_staged: bool = False,
    sync_named: bool = False,
    **settings,
) -> MergeResult | None:
    """Merge ``source`` into the table at ``path`` and write back the partitions that changed.

    Partition columns must belong to the match key, so that a row cannot change partition:
    then only the partitions named by the source are read, and of those only the ones with an
    inserted, updated or deleted row are written. A ``sync`` needs ``sync_named``, which confines it to the partitions
    that the source names: these then equal the source. Repeating a merge that failed half-way is
    safe. Returns the result, readable only with ``keep_staged``; None if nothing was asked.
    """
    options = (options or MergeOptions()).with_(**settings)
    key = list(options.match_on or spec.key)
    if not set(partition_by) <= set(key):
        raise ValueError(f"partition columns {list(partition_by)} must belong to the match key {key}")
    if operation == "sync" and not sync_named:
        raise ValueError("a sync concerns every partition; merge the whole table and publish that, or set sync_named")
    spark = source.sparkSession
    if options.column_mapping:
        source, options = rename_columns(source, options.column_mapping), options.with_(column_mapping=None)
    stored = read_folder(spark, path, schema)
    stored, any_named = _only(stored, source, partition_by)
    if not any_named:
        return None
    copy = stage_path(spark, "folder")
    merged = merge(stored, source, spec, operation, options).staged(copy)

    parts = [F.col(quote(c)) for c in partition_by]
    state = merged.classified.groupBy(*parts).agg(
        F.count_if(F.col(ACTION).isNotNull()).alias("__changed"),
        F.count_if(F.col(ACTION).isNull() | (F.col(ACTION) != "D")).alias("__left"),
    ).filter("__changed > 0")
    on = reduce(and_, [F.col(quote("r", c)).eqNullSafe(F.col(quote("p", c))) for c in partition_by])
    rows = merged.result.alias("r").join(state.filter("__left > 0").alias("p"), on, "left_semi")
    publish_partitions(rows, path, partition_by, staged=True)
    if operation in ("delete", "changes", "sync"):
        _drop_emptied(spark, path, schema, state.filter("__left = 0"), partition_by)
    if not keep_staged:
        discard(spark, copy)
    return merged


def _drop_emptied(spark: SparkSession, path: str, schema, emptied: DataFrame, partition_by: Sequence[str]) -> None:
    """Remove the folders of partitions that lost their last row: no write replaces those."""
    stored = read_folder(spark, path, schema).withColumn("__folder", F.regexp_replace(F.input_file_name(), "/[^/]*$", ""))
    left, some = _only(stored, emptied, partition_by)
    for row in left.select("__folder").distinct().collect() if some else ():  # one per emptied partition
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row[0]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
