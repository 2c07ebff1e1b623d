"""Cases that once gave wrong results without a word."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import confusion, counting, sampling, voting


def test_balance_ends_where_the_given_count_is_too_high(spark):
    df = spark.range(50).select(F.col("id").alias("flow_id"), F.lit("a").alias("label"))
    assert sampling.balance(df, {"a": 100}, "flow_id", 1, counts={"a": 100_000}).count() == 50
    assert sampling.balance(df, {"a": 20}, "flow_id", 1, counts={"a": 100_000}).count() == 20
    assert sampling.balance(df, {"a": 20}, "flow_id", 1, counts={"a": 21}).count() == 20


@pytest.mark.parametrize("share", [0.0, 0.004, 0.125, 0.2, 1.0])
def test_any_test_share(spark, share):
    n = 100_000
    df = spark.range(n).withColumnRenamed("id", "flow_id")
    found = sampling.split(df, "flow_id", share, 42)[1].count()
    assert abs(found - n * share) <= 5 * (n * share * (1 - share)) ** 0.5
    assert counting.split_ratio(df, "flow_id", share, 42).first().test_rows == found


def test_confusion_matrix_keeps_every_row(spark):
    classes = spark.createDataFrame([("a", 0.0, 5), ("b", 1.0, 3)], "label string, label_index double, count long")
    cells = spark.createDataFrame([(0.0, 0.0, 3), (0.0, 7.0, 2), (1.0, 1.0, 3), (9.0, 0.0, 4)], "label_index double, final_prediction double, count long")
    rows = {r["label"]: (r["a"], r["b"], r[confusion.OTHER]) for r in confusion.confusion_matrix(cells, classes, ["a", "b"]).collect()}
    assert rows == {"a": (3, 0, 2), "b": (0, 3, 0), "9": (4, 0, 0)}


def test_a_key_scored_twice_is_an_error(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (1, 0, 2.0)], "flow_id long, model int, pred double")
    with pytest.raises(Exception, match="scored twice by one member: 1"):
        voting.votes_wide(rows, "flow_id", 2).collect()
    some = spark.createDataFrame([(1, 0, 1.0), (2, 0, None), (2, 1, 4.0)], "flow_id long, model int, pred double")
    assert [tuple(r) for r in voting.votes_wide(some, "flow_id", 2).collect()] == [(2, None, 4.0)]


def test_fingerprints_tell_rows_apart(spark):
    def digest(*rows):
        return counting.fingerprint(spark.createDataFrame(list(rows), "x string, y string")).first().digest

    assert digest(("a|b", "c")) != digest(("a", "b|c"))
    assert digest(("ab", "c")) != digest(("a", "bc"))
    assert digest(("\\N", "c")) != digest((None, "c")) and digest(("-", "c")) != digest((None, "c"))
    assert digest(("1:a", "")) != digest(("", "1:a")) and digest((None, "c")) == digest((None, "c"))


def test_fingerprint_of_a_time_does_not_follow_the_session_zone(spark):
    df = spark.range(3).select(F.timestamp_seconds("id").alias("t"))
    first = counting.fingerprint(df).first().digest
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert counting.fingerprint(df).first().digest == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
