"""Shared scratch space and materialised tables.

The folder is the one the cluster names in spark.checkpoint.dir, which every
executor can reach. Only where that is unset, as in local tests, is a local
folder made.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_base(spark: SparkSession) -> str:
    context = spark.sparkContext
    shared = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="flowgauge-"))
        shared = context.getCheckpointDir()
    return shared.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """Path of a new folder; never reused, so no stale file is ever read."""
    path = f"{scratch_base(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _open_scopes.get():
        made.append(path)
    return path


# The scopes that this thread of work is in; `together` hands them to its threads.
_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("open_scopes", default=())


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the scratch folders that were made inside it, and no others.

    Inside means by the code that the scope surrounds, whatever other threads make
    meanwhile. A scope in a scope removes its own folders at its end. Tables that
    live on must be written elsewhere before that.
    """
    made: list[str] = []
    before = _open_scopes.set((*_open_scopes.get(), made))
    try:
        yield
    finally:
        _open_scopes.reset(before)
        for path in made:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder or file of any file system that Spark reads; one that is gone is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> DataFrame:
    """Write the table once and read it back: later steps do not recompute it.

    With `by` each value of these columns, which then come last, has its own folder; a filter on them reads no other.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame) -> DataFrame:
    """A class-level table, computed once and written as one file.

    Spark knows the size of the file, broadcasts it below its own bound and
    shuffles the join beyond.
    """
    return written(df.coalesce(1), "lookup")
