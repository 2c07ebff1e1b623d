"""Edge rows that every operator takes, and plain helpers to check against."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))

# Names that operators use inside stand beside the columns of documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, at long, id string, row string, part int, shard string, key string"


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def edge_rows() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, lang): nulls, empty and very long texts, ties, repeated rows."""
    plain = "The Quick brown fox. Jumps over the lazy dog; Été naïve été!"
    return [
        (1, None, "en"), (2, "", "en"), (3, " \t\r\n\x0b", None), (4, "One", "en"), (5, plain, "en"), (6, plain, "de"),
        (6, plain, "de"), (7, LONG, "en"), (8, f"before {PASSAGE} after", "fr"), (9, f"other {PASSAGE} words {PASSAGE}", None),
        (None, f"nobody {PASSAGE}", "fr"), (None, None, None), (10, "a\nb\n\na\nb c\n" * 30, "en"), (11, "x" * 5000, ""),
        (12, "\U0001f600 İı 中文 中文", "zh"),
    ]


def edge_documents(spark: SparkSession, rows=None) -> DataFrame:
    rows = edge_rows() if rows is None else rows
    full = [(i, t, lang, None, None if t is None else len(t), 7, "x", "y", 3, "z", "k") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def documents_of(spark: SparkSession, sf_dir: str) -> list[tuple[int, str | None]]:
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
