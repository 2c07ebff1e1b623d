"""Report texts as tables: one row per line and one row per table cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions import markup


def stripped_texts(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    return texts.select(key, markup.strip_markup(F.col(text)).alias(text))


def _lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line): every line, stripped."""
    raw = texts.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "raw"))
    return raw.select(key, F.col("line_no").cast("bigint"), markup.strip_edges(F.col("raw")).alias("line"))


def report_lines(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no, kind, body) of every line; table separators are skipped."""
    shown = _lines(texts, key, text).filter(~markup.is_separator(F.col("line")))
    typed = shown.withColumn("kind", markup.line_kind(F.col("line")))
    bodies = typed.select(key, "line_no", "kind", markup.line_body(F.col("line"), F.col("kind")).alias("body"))
    return bodies.withColumn("body", markup.strip_markup(F.col("body")))


def table_cells(texts: DataFrame, key: str, width: int, text: str = "text") -> DataFrame:
    """(key, line_no, cell_no, cell, shown, is_header) of every table row.

    A table is a run of lines that start with a bar; the first of them that
    shows a cell is its header. `shown` is the first `width` characters of a
    cell. Tables are cut out of the lines of their text as arrays, so nothing is
    shuffled.
    """
    lines = texts.select(key, F.transform(F.split(F.col(text), "\n"), markup.strip_edges).alias("lines"))

    def in_table(place: Column) -> Column:
        return F.coalesce(F.get("lines", place).startswith("|"), F.lit(False))

    places = F.sequence(F.lit(0), F.size("lines") - 1)
    first = F.filter(places, lambda i: in_table(i) & ~in_table(i - 1))
    last = F.filter(places, lambda i: in_table(i) & ~in_table(i + 1))
    ends = lines.select(key, "lines", F.arrays_zip(first.alias("first"), last.alias("last")).alias("ends"))
    tables = F.transform(
        "ends", lambda e: F.struct(e["first"].alias("first"), F.slice("lines", e["first"] + 1, e["last"] - e["first"] + 1).alias("rows"))
    )
    table = ends.select(key, F.explode(tables).alias("table")).select(key, "table.first", "table.rows")
    cells = F.transform("rows", lambda line: F.when(~markup.is_separator(line), markup.shown_cells(line)))
    rows = table.select(key, "first", cells.alias("cells"))
    header = F.array_position(F.transform("cells", lambda c: F.coalesce(F.size(c) > 0, F.lit(False))), True) - 1
    row = rows.select(key, "first", header.alias("header"), F.posexplode("cells").alias("place", "cells"))
    cell = row.select(
        key,
        (F.col("first") + F.col("place")).cast("bigint").alias("line_no"),
        (F.col("place") == F.col("header")).alias("is_header"),
        F.posexplode("cells").alias("cell_no", "cell"),
    )
    whole = cell.withColumn("cell", markup.strip_markup(F.col("cell")))
    return whole.select(
        key,
        "line_no",
        F.col("cell_no").cast("bigint").alias("cell_no"),
        "cell",
        F.substring("cell", 1, width).alias("shown"),
        "is_header",
    )
