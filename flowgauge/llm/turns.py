"""Conversations in the order of their turns, dealt out by ranges.

A conversation is never gathered: it lies in one range, or in several that
follow each other, however many rows it has. Rows of a conversation go by turn,
nulls first, then by role, then by a hash of the text; what is equal in all
three is the same row twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def turns_of(df: DataFrame, **columns: str) -> DataFrame:
    """The columns that a conversation needs, under fixed names; others of the same names do not clash."""
    return df.select(*[F.col(given).alias(name) for name, given in columns.items()])


def in_order(rows: DataFrame) -> DataFrame:
    """All rows sorted over the whole table, with the number of their part; rows of one key are dealt on too."""
    placed = rows.withColumns({"tie": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "tie", "at"]
    sorted_rows = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "at")
    return sorted_rows.withColumn("part", F.spark_partition_id())


def rows_of(batches: Iterator[pa.RecordBatch], most: int = 512) -> Iterator[dict]:
    """Rows one by one; only a few are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield from batch.slice(at, most).to_pylist()


def batches_of(rows: Iterator[dict], schema: pa.Schema, most_rows: int = 2_000, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches bounded by rows and by the bytes of their texts."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, (str, bytes)))
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def hex_digest(parts: Iterator[bytes] | list[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()
