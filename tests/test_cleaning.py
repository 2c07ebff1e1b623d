from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from flowgauge.operators import cleaning as ops
from flowgauge.operators.counting import fingerprint, label_counts, null_counts
from flowgauge.params import DROPPED_COLUMNS, CleanParams
from flowgauge.registry import views as v


def test_null_marker_and_null_labels_go(spark):
    df = spark.createDataFrame([("NULL",), (None,), ("a",)], "label string")
    assert [r.label for r in ops.labelled(df).collect()] == ["a"]
    assert [r.label for r in ops.residual_classes(df, ["b"]).collect()] == ["a"]


@pytest.mark.parametrize("text", ["inf", "-inf", "NaN", "TCP", "", None, "Infinity"])
def test_bad_numbers_are_dropped(spark, text):
    df = spark.createDataFrame([(1, text, "a"), (2, "7.5", "a")], "flow_id long, duration string, label string")
    out = ops.clean(df, CleanParams(), keep=("flow_id",))
    assert out.collect() == [Row(flow_id=2, duration=7.5, label="a")]


def test_clean_equals_its_single_steps(spark, sf_dir):
    rows = ops.labelled(v.dirty(spark, sf_dir))
    narrow = ops.drop_columns(rows, v.CLEAN, keep=(v.KEY,))
    steps = ops.drop_incomplete(ops.infinite_to_null(ops.cast_to_double(narrow, v.CLEAN.cast_columns)))
    whole = ops.clean(rows, v.CLEAN, keep=(v.KEY,))
    assert whole.count() > 0
    assert steps.exceptAll(whole).count() == 0 and whole.exceptAll(steps).count() == 0


def test_dropped_columns_ignore_case_and_absence(spark):
    df = spark.range(1).select(F.lit(1).alias("packet_iat_total"), F.lit("TCP").alias("protocol"), F.lit(2).alias("keep_me"))
    assert ops.drop_columns(df, CleanParams()).columns == ["keep_me"]
    assert len(DROPPED_COLUMNS) == len(set(DROPPED_COLUMNS)) == 75


def test_cleaning_is_one_narrow_stage(spark, sf_dir, capsys):
    ops.clean(ops.labelled(v.dirty(spark, sf_dir)), v.CLEAN, keep=(v.KEY,)).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "src_ip" not in plan


def test_label_filter_reaches_the_scan(spark, tmp_path, capsys):
    spark.createDataFrame([("a", 1.0), ("b", 2.0)], "label string, x double").write.parquet(str(tmp_path / "t"))
    ops.only_class(spark.read.parquet(str(tmp_path / "t")), "a").select("label").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(label,a)" in plan and "ReadSchema: struct<label:string>" in plan


def test_feature_columns_leave_out_label_index_and_key(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 1.0)], "flow_id long, label string, label_index double, x double")
    assert ops.feature_columns(df, "flow_id") == ["x"]


def test_null_counts_tell_null_nan_and_infinity_apart(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1.0,)], "x double")
    assert null_counts(df).collect() == [Row(column="x", nulls=1, nans=1, infinities=1)]


def test_label_ties_go_by_name(spark):
    df = spark.createDataFrame([(x,) for x in "bacc"], "label string")
    assert [r.label for r in label_counts(df).collect()] == ["c", "a", "b"]


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    first = fingerprint(df).first()
    assert first == fingerprint(df.repartition(7).orderBy(F.desc("id"))).first()
    assert first != fingerprint(df.withColumn("x", F.when(F.col("id") == 5, 0).otherwise(F.col("x")))).first()
