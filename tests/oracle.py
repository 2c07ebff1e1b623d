"""Runs named queries in Spark and DuckDB and compares whole results."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value: object) -> object:
    if value is None:
        return "null"
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    return f"{value}"


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both results are equal, else what differs."""
    con.execute(sql)
    columns = [d[0] for d in con.description]
    expected = _rows(columns, con.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
