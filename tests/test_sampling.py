from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import sampling as ops
from flowgauge.registry import views as v


def _skewed(spark, n=6000):
    """Half of the rows in one class, a third in another, the rest small classes."""
    label = (
        F.when(F.col("id") % 6 < 3, "hot").when(F.col("id") % 6 < 5, "warm").otherwise(F.concat(F.lit("c"), F.col("id") % 30))
    )
    return spark.range(n).select(F.col("id").alias("flow_id"), label.alias("label"))


def _brute(rows, caps, seed):
    kept = set()
    groups = {}
    for r in rows:
        groups.setdefault(r.label, []).append(r.flow_id)
    for label, ids in groups.items():
        ids.sort(key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), str(i)))
        kept.update(ids[: caps.get(label, len(ids))])
    return kept


@pytest.mark.parametrize(
    "caps", [{"hot": 100, "warm": 50}, {"hot": 3000}, {"hot": 2999, "warm": 1}, {"hot": 10**6, "absent": 5}, {"hot": 0}, {}]
)
def test_balance_keeps_the_smallest_hashes(spark, caps):
    df = _skewed(spark)
    kept = {r.flow_id for r in ops.balance(df, caps, "flow_id", 7).collect()}
    assert kept == _brute(df.collect(), caps, 7)


def test_balance_does_not_depend_on_partitions(spark):
    df = _skewed(spark)
    one = ops.balance(df.repartition(1), {"hot": 321}, "flow_id", 1)
    seven = ops.balance(df.repartition(7, "flow_id"), {"hot": 321}, "flow_id", 1)
    assert one.exceptAll(seven).count() == 0 and one.count() == seven.count()


@pytest.mark.parametrize("wrong", [400, 30_000])
def test_a_missed_band_is_widened(spark, wrong):
    """Wrong class sizes move the band off the cutoff; the result stays exact."""
    df = _skewed(spark)
    kept = {r.flow_id for r in ops.balance(df, {"hot": 300}, "flow_id", 7, counts={"hot": wrong}).collect()}
    assert kept == _brute(df.collect(), {"hot": 300}, 7)


def test_a_repeated_key_is_reported(spark):
    df = spark.range(50).select(F.lit(1).alias("flow_id"), F.lit("hot").alias("label"))
    with pytest.raises(ValueError, match="not unique"):
        ops.balance(df, {"hot": 10}, "flow_id", 7)


def test_wide_rows_of_a_balanced_table_are_not_shuffled(spark, capsys):
    ops.balance(_skewed(spark), {"hot": 100}, "flow_id", 7).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_sample_of_one_class(spark):
    out = ops.seeded_sample(_skewed(spark), "warm", 40, "flow_id", 3)
    assert out.count() == 40 and out.select("label").distinct().collect()[0][0] == "warm"


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5])
def test_split_is_disjoint_and_complete(spark, share):
    df = spark.range(5000).withColumnRenamed("id", "flow_id")
    train, test = ops.split(df, "flow_id", share, 42)
    assert train.intersect(test).count() == 0
    assert train.count() + test.count() == 5000
    assert abs(test.count() / 5000 - share) < 0.03
    again = ops.split(df.repartition(5), "flow_id", share, 42)[1]
    assert again.exceptAll(test).count() == 0


def test_folds_partition_the_rows(spark):
    folds = ops.with_fold(spark.range(5000).withColumnRenamed("id", "flow_id"), "flow_id", 5, 42)
    sizes = {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert set(sizes) == set(range(5)) and sum(sizes.values()) == 5000
    assert min(sizes.values()) > 850


def test_union_keeps_duplicates_and_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n int")
    assert [tuple(r) for r in ops.union_all(a, b).collect()] == [(1, "x"), (1, "x")]


def test_balanced_rows_match_the_keep_ratio(spark, sf_dir):
    from flowgauge.operators.counting import keep_ratio

    rows = v.dirty(spark, sf_dir)
    assert keep_ratio(rows, v.CAPS).first().balanced_rows == ops.balance(rows, v.CAPS, v.KEY, v.SEED).count()


@pytest.mark.parametrize("width", [8, 256])
@pytest.mark.parametrize("caps", [{"hot": 100, "warm": 50}, {"hot": 3000}, {"hot": 2999, "c5": 1, "warm": 10**6}, {"hot": 0, "absent": 3}, {}])
def test_first_rows_of_each_class_in_any_order(spark, caps, width):
    """A skewed order with ties and nulls, sketches so small that bands miss."""
    order = F.when(F.col("flow_id") % 50 != 7, F.floor(F.exp((F.col("flow_id") * 37 % 6000) / 400.0)).cast("long"))
    df = _skewed(spark).withColumn("age", order)
    rows = df.collect()
    wanted = set()
    for name in {r.label for r in rows}:
        mine = sorted((r for r in rows if r.label == name), key=lambda r: (r.age is None, r.age or 0, str(r.flow_id)))
        wanted |= {r.flow_id for r in mine[: caps.get(name, len(mine))]}
    found = ops.first_per_class(df.repartition(5), caps, F.col("age"), "flow_id", width=width).collect()
    assert {r.flow_id for r in found} == wanted and len(found) == len(wanted)


def test_sizes_and_quantiles_come_from_one_pass(spark, monkeypatch):
    """The table is read by one sketch pass, one ranking and one filter, where counting and quantiles apart read it once more."""
    reads = []
    df = _skewed(spark)
    for name in ("_sketch_bands", "_ranked_values", "_class_sizes"):
        real = getattr(ops, name)
        monkeypatch.setattr(ops, name, lambda *a, real=real, name=name: (reads.append(name), real(*a))[1])
    ops.first_per_class(df, {"hot": 100}, F.col("flow_id"), "flow_id").collect()
    assert reads == ["_sketch_bands", "_ranked_values"]
