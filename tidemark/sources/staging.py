"""Write an intermediate result once, in storage every executor can reach.

Used where a plan must not be recomputed (generated numbers) or is read several times. The
rows go to a Parquet folder below ``spark.checkpoint.dir``, so losing an executor costs a
re-read and not a recomputation, and later readers fetch only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names; a private one only on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to storage shared by all executors")
    return _private_root()


@cache
def _private_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "rows", path: str | None = None) -> DataFrame:
    """Materialise ``df`` and return a DataFrame that reads the stored copy."""
    spark = df.sparkSession
    path = path or stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged copy that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard_all(spark: SparkSession) -> None:
    """Remove every copy this application has staged; for the end of a job."""
    discard(spark, f"{staging_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
