"""Which rows differ between two versions of a table: a digest tree over hash buckets of the row key.

The leaves are buckets of the key's md5; a leaf holds the number of its rows and
the sum of 60 bits of their md5, so it depends neither on order nor on partitioning. A
node above sums its LEVELS children, so levels add up from the leaves by one
aggregation each. Two stored trees are compared from the root down: only children
of nodes that differ are read, and where the roots are equal nothing else is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.hashing import hash_number, hash_text
from flowgauge.operators.counting import row_hash

BITS = 12
STEP = 4
SCHEMA = "bucket int, rows bigint, digest decimal(38,0), level int, part int"


def leaf_bucket(key: str, bits: int = BITS) -> Column:
    """The first bits of the key's digest."""
    return F.shiftright(hash_number(hash_text("digest-tree", key)), 32 - bits).cast("int")


def levels_of(bits: int) -> list[int]:
    """Bits of the levels from the root to the leaves."""
    return sorted({0, bits, *range(STEP, bits, STEP)})


def digest_tree(df: DataFrame, key: str, columns: Sequence[str] | None = None, bits: int = BITS) -> DataFrame:
    """Rows (bucket, rows, digest, level, part): one for each bucket of each level that has rows.

    `part` is the bucket's first STEP bits, by which a stored tree is laid out (0 on
    the upper levels). Leaves are summed on the map side; there are 2 ** bits of them
    at most. A null key has the bucket of no text.
    """
    names = list(columns) if columns is not None else df.columns
    of_row = F.conv(F.substring(row_hash(df, names), 1, 15), 16, 10).cast("decimal(28,0)")
    measured = df.select(leaf_bucket(key, bits).alias("leaf"), of_row.alias("of_row"))
    leaves = measured.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.sum("of_row").alias("digest"))
    first = F.shiftright("leaf", max(0, bits - STEP))
    nodes = [
        F.struct(
            F.lit(level).alias("level"),
            F.shiftright("leaf", bits - level).alias("bucket"),
            (first if level > STEP else F.lit(0)).alias("part"),
        )
        for level in levels_of(bits)
    ]
    spread = leaves.select(F.inline(F.array(*nodes)), "rows", "digest")
    sums = [F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest")]
    return spread.groupBy("level", "bucket", "part").agg(*sums).select("bucket", "rows", "digest", "level", "part")


def write_tree(tree: DataFrame, path: str) -> None:
    """Store a tree in a folder for each level and each first STEP bits."""
    tree.repartition("level", "part").write.partitionBy("level", "part").parquet(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose rows or digest differ, a missing one counting as empty."""
    old = before.select("bucket", F.col("rows").alias("rows_before"), F.col("digest").alias("was"))
    new = after.select("bucket", F.col("rows").alias("rows_after"), F.col("digest").alias("is"))
    both = old.join(new, "bucket", "full")
    same = F.col("rows_before").eqNullSafe(F.col("rows_after")) & F.col("was").eqNullSafe(F.col("is"))
    zero = F.lit(0).cast("bigint")
    return both.where(~same).select("bucket", F.coalesce("rows_before", zero).alias("rows_before"), F.coalesce("rows_after", zero).alias("rows_after"))


def differing_buckets(before: DataFrame, after: DataFrame, bits: int = BITS) -> DataFrame:
    """(bucket, rows_before, rows_after) of the leaves that differ between two stored trees.

    One pass a level; a level reads the folders and buckets below the nodes that
    differ above it. The driver holds the numbers of these, at most
    2 ** (bits - STEP) of them.
    """
    order = levels_of(bits)
    parents, found = [0], None
    for above, level in zip([0, *order], order):
        parts = sorted({p >> (above - STEP) for p in parents}) if level > STEP else [0] if parents else []
        wanted = (F.col("level") == level) & F.col("part").isin(parts) & F.shiftright("bucket", level - above).isin(parents)
        found = _differing(before.where(wanted), after.where(wanted))
        if level < bits:
            parents = [r["bucket"] for r in found.select("bucket").collect()]
    return found


def changed_rows(before: DataFrame, after: DataFrame, buckets: DataFrame, key: str, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """(key, change) of the rows in the differing buckets: added, removed or changed; the key must be unique."""

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.withColumn("bucket", leaf_bucket(key, bits)).join(buckets.select("bucket"), "bucket", "left_semi")
        return rows.select(key, row_hash(df, columns).alias(name))

    both = side(before, "was").join(side(after, "is"), key, "full")
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(F.col("was") != F.col("is"), "changed")
    return both.select(key, change.alias("change")).where("change is not null")
