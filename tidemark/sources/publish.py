"""Making a result the table's new content.

Merges are pure plans; these functions write. A table that is being read is never
overwritten in place: a new version is written beside it and a view is switched, or, for
partitioned tables, the changed partitions are staged first and then swapped in.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.names import quote
from .staging import stage


def append(df: DataFrame, table: str, order_hint: Sequence[str] = (), descending: Sequence[str] = ()) -> None:
    """Add rows to a table. ``order_hint`` only lays out each file, it shuffles nothing."""
    if order_hint:
        df = df.sortWithinPartitions(
            *[F.col(quote(c)).desc() if c in descending else F.col(quote(c)).asc() for c in order_hint]
        )
    df.write.mode("append").saveAsTable(table)  # columns are matched by name


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def _versions(spark: SparkSession, name: str) -> list[int]:
    """The version tables of ``name`` that exist, oldest first."""
    database, _, plain = name.rpartition(".")
    pattern = re.compile(re.escape(plain.lower()) + r"__v(\d+)$")
    listed = spark.sql(f"SHOW TABLES{' IN ' + database if database else ''} LIKE '{plain}__v*'").collect()
    return sorted(int(m.group(1)) for m in (pattern.match(row.tableName.lower()) for row in listed) if m)


def _next_version(spark: SparkSession, name: str) -> int:
    return max(_versions(spark, name), default=0) + 1


def current_version(spark: SparkSession, name: str) -> int | None:
    """The version the view ``name`` reads; None if there is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {name}").first()[0].lower()
    found = re.findall(re.escape(name.rpartition(".")[2].lower()) + r"__v(\d+)", text)
    return int(found[-1]) if found else None


def drop_old_versions(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Drop versions once no reader uses them any more: all but ``keep``, counted back from the one the view reads.

    A newer version, left by a publication that failed before it switched the view, is dropped as well, so
    this must not run beside one. Without a view nothing is dropped.
    """
    if keep < 1:
        raise ValueError("at least the current version has to be kept")
    live = current_version(spark, name)
    if live is None:
        return []
    known = _versions(spark, name)
    kept = [v for v in known if v <= live][-keep:]
    old = [f"{name}__v{v}" for v in known if v not in kept]
    for table in old:
        spark.sql(f"DROP TABLE {table}")
    return old


def publish_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0
) -> str:
    """Write ``df`` as a new version table, then point the view ``name`` at it.

    Readers see the old version until the switch, which is a single metastore call. Returns
    the version table's name; older versions are left for running readers to finish with, and
    removed by :func:`drop_old_versions`.
    Bucketed by its key, the table is not shuffled again by the merges that follow.
    """
    spark = df.sparkSession
    version = f"{name}__v{_next_version(spark, name)}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return version


def publish_tables(results: Mapping[str, DataFrame]) -> dict[str, str]:
    """Write every new version first and switch all views last, in the given order.

    A failure while writing leaves every table as it was. The switches themselves are one
    call each, so a reader may for a moment see parents ahead of children.
    """
    spark = next(iter(results.values())).sparkSession
    versions = {}
    for name, df in results.items():
        versions[name] = f"{name}__v{_next_version(spark, name)}"
        df.write.format("parquet").saveAsTable(versions[name])
    for name, version in versions.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return versions


def publish_partitions(df: DataFrame, path: str, partition_by: Sequence[str], staged: bool = False) -> None:
    """Replace, in a partitioned folder, exactly the partitions that ``df`` holds rows for.

    ``df`` may read from ``path``, so unless it is ``staged`` already it is written aside
    first. The rebalance hint gives each partition few files and splits a large one over
    several tasks.
    """
    rows = df if staged else stage(df, "publish")
    (
        rows.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def observe_actions(df: DataFrame, actions: Sequence[str] = ("I", "U", "D")) -> tuple[DataFrame, Observation]:
    """Count a change feed's actions as a by-product of whatever job consumes it."""
    seen = Observation()
    counts = [F.count_if(F.col("__action") == a).alias(a) for a in actions]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen
