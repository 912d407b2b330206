"""The named queries over the given tables, each beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``tables.orders`` reads ``orders.parquet`` of the data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = df  # resolved once per query
        return df


def query(sql: str | None = None, name: str | None = None):
    """Register a function of :class:`Tables`, under its own name unless another is given."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return register
