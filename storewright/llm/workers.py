"""Memory of Python workers. Spark reuses them, so what a task leaves behind would add up over the stages of a job."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def give_back() -> None:
    """Free pages of the allocators go back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that gives its memory back at the end of the task."""

    def each(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            give_back()

    return each


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """What runs meanwhile hands Python batches of about so many bytes at most, or of one row."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(most_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)
