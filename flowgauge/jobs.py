"""Helpers for several Spark actions: submitted together, or over one kept table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

In = TypeVar("In")
Out = TypeVar("Out")

FILES_AT_ONCE = 4


def together(work: Callable[[In], Out], items: Sequence[In], at_once: int) -> list[Out]:
    """work(item) for each item, from a few driver threads; Spark shares out the tasks.

    The threads have the caller's context, so its scratch scopes hold for them.
    """
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return [t.result() for t in [pool.submit(copy_context().run, in_session(partial(work, item))) for item in items]]


@contextmanager
def kept(df: DataFrame) -> Iterator[None]:
    """Keeps a table in memory, or on disk, while several actions read it."""
    already = df.storageLevel.useMemory or df.storageLevel.useDisk
    if not already:
        df.persist()
    try:
        yield
    finally:
        if not already:
            df.unpersist()
