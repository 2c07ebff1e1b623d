"""Counts per class and per column, ratios and fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions.hashing import hash_number
from flowgauge.functions.measures import ratio
from flowgauge.operators.sampling import is_test_row
from flowgauge.params import NULL_LABEL


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class, most frequent first, ties by name."""
    return _class_sizes(df, label).orderBy(F.desc("count"), "label")


def _class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def class_table(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_index, count): index 0 is the most frequent class.

    The window has no partition: its input is one row per class, already
    counted, and the index is by definition one order over all classes.
    """
    order = W.orderBy(F.desc("count"), "label")
    return _class_sizes(df.filter(F.col(label).isNotNull()), label).select(
        "label", (F.row_number().over(order) - 1).cast("double").alias("label_index"), "count"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls, NaNs and infinities of every column, from one pass."""
    rows = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        real = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        never = F.lit(0).cast("bigint")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.count_if(value.isNull()).alias("nulls"),
                (F.count_if(F.isnan(value)) if real else never).alias("nans"),
                (F.count_if(value.isin(float("inf"), float("-inf"))) if real else never).alias("infinities"),
            )
        )
    return df.agg(F.array(*rows).alias("found")).select(F.inline("found"))


def keep_ratio(df: DataFrame, caps: Mapping[str, int], label: str = "label") -> DataFrame:
    """Rows before and after balancing, and the share kept in percent.

    Balancing keeps exactly min(cap, n) rows of a class, so class counts suffice.
    """
    sizes = _class_sizes(df, label).withColumnRenamed("count", "n")
    cap = F.col("n")
    for name, value in caps.items():
        cap = F.when(F.col("label") == name, F.least("n", F.lit(value).cast("bigint"))).otherwise(cap)
    kept = F.when(F.col("label") != NULL_LABEL, cap).otherwise(F.lit(0).cast("bigint"))
    return sizes.agg(F.sum("n").alias("raw_rows"), F.sum(kept).alias("balanced_rows")).withColumn(
        "kept_percent", F.round(ratio(F.col("balanced_rows"), F.col("raw_rows")) * 100.0, 1)
    )


def split_ratio(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """Rows and percent of the train and test part, from one pass."""
    test = is_test_row(key, share, seed)
    return df.agg(F.count_if(~test).alias("train_rows"), F.count_if(test).alias("test_rows")).select(
        "train_rows",
        "test_rows",
        F.round(ratio(F.col("train_rows"), F.col("train_rows") + F.col("test_rows")) * 100.0, 2).alias("train_percent"),
        F.round(ratio(F.col("test_rows"), F.col("train_rows") + F.col("test_rows")) * 100.0, 2).alias("test_percent"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and an order-independent digest of the listed columns.

    The digest sums 32 bits of each row's md5, so it aggregates on the map side
    and does not depend on order or partitioning. Each value stands after its
    length, so no two rows are written alike; a null has a mark of its own, and
    a time is written as microseconds, whatever the session's zone.
    """
    row = hash_number(row_hash(df, columns if columns is not None else df.columns)).cast("decimal(28,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("digest"))


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 of a row's listed columns, as hex digits."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    return F.md5(F.concat(*[_shown(F.col(f"`{n}`"), fields.get(n)) for n in columns]))


def _shown(value: Column, kind: T.DataType | None) -> Column:
    text = (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
