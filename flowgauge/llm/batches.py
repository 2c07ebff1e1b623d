"""Arrow batches bounded by bytes while a table is written.

A batch may hold 10,000 rows whatever their size, in the JVM's buffers and again
in each Python worker. The operators work on a few megabytes at a time, so no more
is handed over at once. The session has its own setting back after the write.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from flowgauge.sources.scratch import written

MOST = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


@contextmanager
def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    before = spark.conf.get(MOST)
    spark.conf.set(MOST, str(most))
    try:
        yield
    finally:
        spark.conf.set(MOST, before)


def written_in_batches(df: DataFrame, name: str) -> DataFrame:
    """`written`, with bounded Arrow batches on the way."""
    with bounded_batches(df.sparkSession):
        return written(df, name)
