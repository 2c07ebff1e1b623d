"""Histogram sort against exact sums."""

from __future__ import annotations

import zlib

import pytest
from llm_frames import edge_documents, edge_rows

from flowgauge.llm.entry import QUERIES
from flowgauge.llm.histogram_sort import shard_by_bytes, text_size
from pyspark.sql import functions as F


def check_slots(rows, shards):
    slots = {}
    for r in rows:
        assert 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_query(spark, sf_dir):
    rows = QUERIES["op1_histogram_sort"].run(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    check_slots(rows, 24)
    size = dict.fromkeys(range(24), 0)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        size[r["shard"]] += r["size"]
    largest = max(r["size"] for r in rows)
    assert max(size.values()) - min(size.values()) <= 2 * largest


@pytest.mark.parametrize("copies", [1, 400])
def test_one_text_with_a_third_of_all_rows_is_cut(spark, copies):
    rows = [(i, "hot text " * 20, "en") for i in range(copies)] + [(1000 + i, f"text {i} " * 20, "en") for i in range(800)]
    found = shard_by_bytes(edge_documents(spark, rows), 8)
    sums = [r["s"] for r in found.groupBy("shard").agg(F.sum(text_size(F.col("text"))).alias("s")).collect()]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2 * 200
    check_slots(found.collect(), 8)


def test_repeated_rows_are_cut_too(spark):
    found = shard_by_bytes(edge_documents(spark, [(1, "same", "en")] * 90 + [(None, None, None)] * 60), 5)
    sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert sum(sizes) == 150 and len(sizes) == 5
    check_slots(found.collect(), 5)


def test_edges(spark):
    found = shard_by_bytes(edge_documents(spark), 3)
    rows = found.collect()
    check_slots(rows, 3)
    assert len(rows) == len(edge_rows())
    assert {"at", "id", "row", "part", "key"} <= set(found.columns) and found.schema["shard"].dataType.simpleString() == "int"
    assert shard_by_bytes(edge_documents(spark, []), 3).count() == 0


def test_buckets_keep_order_and_slots(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = {(r["doc_id"], r["shard"], r["slot"]) for r in shard_by_bytes(docs, 4).collect()}
    many = {(r["doc_id"], r["shard"], r["slot"]) for r in shard_by_bytes(docs, 4, bucket_bytes=20_000).collect()}
    # The same order, cut at borders that may differ by the tolerance.
    assert len(one) == len(many)
    check_slots([dict(zip(("doc_id", "shard", "slot"), x)) for x in many], 4)


def test_no_python_on_executors(spark, sf_dir):
    plan = QUERIES["op1_histogram_sort"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and plan.count("Exchange") == 1
