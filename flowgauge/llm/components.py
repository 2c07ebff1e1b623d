"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.sources.scratch import written


def _stars(edges: DataFrame) -> DataFrame:
    """Every u joined to the smallest of its neighbours and itself; pre-aggregated, hot u split by AQE."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return edges.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _stars(down)
    moved = starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(starred.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def star_components(edges: DataFrame) -> DataFrame:
    """(u, v) with v the smallest value reachable from u, for every u that is not the smallest itself.

    Takes undirected edges u, v in any order, repeated ones included. Each round
    writes the edges, so a lost executor costs a round at most; the driver sees a
    count and a checksum.
    """
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    edges = written(edges.where("u <> v").distinct(), "edges")
    before = edges.agg(mark.alias("m")).first()["m"]
    while before[0]:
        edges = written(_small(_large(edges)), "edges")
        after = edges.agg(mark.alias("m")).first()["m"]
        if after == before:
            break
        before = after
    return edges


def local_components(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of `size` items, for links a[i] - b[i] within one task."""
    label = np.arange(size)
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(label[label], label):
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label
