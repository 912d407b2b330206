"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage, stage_path, staging_root  # noqa: F401  (re-exported)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8_length(text: Column) -> Column:
    """Bytes of the UTF-8 form; none for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, which stands for the text; NULL for NULL."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def slices(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive items into runs of about ``most`` in total, one item at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def frugal(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function for Spark that hands its memory back when it ends.

    Python workers wait for further tasks beside the executor's heap; the allocator would keep what the last task took.
    """

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # where there is no such call, memory is kept
            ctypes.CDLL(None).malloc_trim(0)

    return run
