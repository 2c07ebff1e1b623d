"""Majority vote and alignment of member predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.vote import majority_of

VOTES = "_votes"


def with_vote(df: DataFrame, members: Sequence[str], out: str = "final_prediction") -> DataFrame:
    """Adds the majority vote of the member columns.

    The votes are put into an array column first. Written as one expression over
    all member columns, the generated method grows beyond what the JVM compiles.
    """
    gathered = df.withColumn(VOTES, F.array(*[F.col(m) for m in members]))
    return gathered.withColumn(out, majority_of(F.col(VOTES), len(members))).drop(VOTES)


def agreement(members: Sequence[str], choice: str = "final_prediction") -> Column:
    """How many members cast the chosen vote."""
    return reduce(add, [F.coalesce(F.col(m) == F.col(choice), F.lit(False)).cast("bigint") for m in members])


def line_up_votes(members: Sequence[DataFrame], key: str, prediction: str = "prediction") -> DataFrame:
    """Predictions of separately scored members as columns pred_0.. per row key.

    One shuffle for all members instead of a chain of joins. A key that some
    member has not scored is left out, as in an inner join.
    """
    long = [
        m.select(F.col(key), F.lit(i).alias("model"), F.col(prediction).alias("pred")) for i, m in enumerate(members)
    ]
    return votes_wide(reduce(lambda a, b: a.unionByName(b), long), key, len(members))


def votes_wide(long: DataFrame, key: str, members: int) -> DataFrame:
    """(key, model, pred) rows as one row per key with pred_0.. columns.

    A key that some member has not scored is left out; one that a member scored
    twice is an error.
    """
    at = [F.col("model") == i for i in range(members)]
    picked = [F.max(F.when(m, F.col("pred"))).alias(f"pred_{i}") for i, m in enumerate(at)]
    scored = [F.count_if(m) for m in at]
    twice = F.raise_error(F.concat(F.lit(f"{key} is scored twice by one member: "), F.col(key).cast("string"))).cast("boolean")
    complete = F.when(F.greatest(F.lit(0), *scored) > 1, twice).otherwise(reduce(and_, [n == 1 for n in scored]))
    return long.groupBy(key).agg(complete.alias("_complete"), *picked).filter("_complete").drop("_complete")


def write_votes(member: DataFrame, table: str, path: str, key: str, buckets: int, prediction: str = "prediction") -> None:
    """Store one member's predictions as a table of sorted buckets of the key.

    Members scored at other times, by other jobs, are stored alike and need no
    shuffle when their votes are lined up. Rows are dealt to the buckets first, so
    a bucket is one file. A null key is an error, as no vote can be lined up by it.
    """
    told = F.raise_error(F.lit(f"{key} is null in the predictions for {table}"))
    known = F.when(F.col(key).isNull(), told.cast(member.schema[key].dataType)).otherwise(F.col(key))
    rows = member.select(known.alias(key), F.col(prediction).alias("pred"))
    dealt = rows.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def line_up_tables(spark: SparkSession, tables: Sequence[str], key: str) -> DataFrame:
    """Predictions of stored members as columns pred_0.. per row key, joined bucket by bucket without an exchange.

    A key that some member has not scored is left out; one that a member scored
    twice is an error. Both are found within a bucket.
    """
    sides = []
    for i, table in enumerate(tables):
        twice = F.raise_error(F.concat(F.lit(f"{key} is scored twice by one member: "), F.col(key).cast("string")))
        grouped = spark.table(table).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max("pred").alias("pred"))
        sides.append(grouped.select(key, F.when(F.col("n") > 1, twice.cast("double")).otherwise(F.col("pred")).alias(f"pred_{i}")))
    return reduce(lambda a, b: a.join(b.hint("merge"), key), sides)
