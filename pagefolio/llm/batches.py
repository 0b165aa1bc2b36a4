"""Bounds on what goes to Python at once.

A batch of texts stands several times in an executor: in the vectors of the JVM, in the buffers to
and from Python, and in Python. These buffers lie outside the heap, and the allocator keeps much of
what the largest ones took, so their size counts for the whole life of an executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ARROW_ROWS, ARROW_BYTES = 1_000, 1024 * 1024
LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS,
    "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES,
}


def bound_batches(spark: SparkSession) -> dict[str, str]:
    """From now on at most these rows and bytes in an Arrow batch of the session; smaller limits stay.

    For results that are computed later, when the caller writes them. Returns the settings before.
    """
    before = {key: spark.conf.get(key) for key in LIMITS}
    for key, most in LIMITS.items():
        held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[key])
        if not 0 < held <= most:  # zero or less is no limit
            spark.conf.set(key, str(most))
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """``bound_batches`` for what is computed meanwhile."""
    before = bound_batches(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
