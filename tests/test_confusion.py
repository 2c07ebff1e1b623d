from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowgauge.operators import confusion as ops
from flowgauge.registry import views as v


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return v.voted(spark, sf_dir, v.classes(spark, sf_dir)).cache()


@pytest.fixture(scope="module")
def report(spark, sf_dir):
    return v.Report(spark, sf_dir)


@pytest.mark.parametrize(
    "ours, theirs",
    [("accuracy", "accuracy"), ("f1_score", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")],
)
@pytest.mark.parametrize("column", ["final_prediction", "pred_3"])
def test_metrics_equal_the_evaluator(scored, ours, theirs, column):
    metrics = ops.global_metrics(ops.confusion_long(scored, predicted=column)).first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label_index", predictionCol=column, metricName=theirs)
    assert metrics[ours] == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


def test_sums_agree(scored, report):
    rows = report.per_class.collect()
    errors = scored.filter("label_index <> final_prediction").count()
    assert sum(r.fp for r in rows) == sum(r.fn for r in rows) == errors
    assert sum(r.tp + r.fn for r in rows) == scored.count()
    assert report.metrics.first().recall == pytest.approx(report.metrics.first().accuracy)


def test_detection_rate_is_recall(report):
    rates = {r.label: r.taux for r in ops.detection_rates(report.confusion, report.classes).collect()}
    assert rates == {r.label: r.recall for r in report.per_class.collect()}


def _small(spark):
    classes = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 2.0)], "label string, label_index double")
    confusion = spark.createDataFrame(
        [(0.0, 0.0, 8), (0.0, 1.0, 2), (1.0, 0.0, 5), (1.0, 7.0, 1)],
        "label_index double, final_prediction double, count long",
    )
    return confusion, classes


def test_empty_and_never_predicted_classes_are_zero(spark):
    confusion, classes = _small(spark)
    rows = {r.label: r for r in ops.per_class_metrics(confusion, classes).collect()}
    assert (rows["c"].precision, rows["c"].recall, rows["c"].f1, rows["c"].tp, rows["c"].fp, rows["c"].fn) == (0, 0, 0, 0, 0, 0)
    assert (rows["b"].precision, rows["b"].recall, rows["b"].f1) == (0, 0, 0)
    assert (rows["a"].tp, rows["a"].fp, rows["a"].fn) == (8, 5, 2)
    assert rows["a"].precision == 61.54
    assert {r.label: r.taux for r in ops.detection_rates(confusion, classes).collect()}["c"] == 0


def test_unknown_index_shows_as_number(spark):
    named = {(r.actual, r.predicted): r["count"] for r in ops.named_confusion(*_small(spark)).collect()}
    assert named == {("a", "a"): 8, ("a", "b"): 2, ("b", "a"): 5, ("b", "7"): 1}


def test_matrix_is_dense(spark):
    confusion, classes = _small(spark)
    rows = {r.label: r for r in ops.confusion_matrix(confusion, classes, ["a", "b", "c"]).collect()}
    assert [rows["a"][x] for x in "abc"] == [8, 2, 0]
    assert [rows["c"][x] for x in "abc"] == [0, 0, 0]


def test_lookups_beyond_the_broadcast_bound_are_joined_by_a_shuffle(spark, sf_dir, report):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = v.Report(spark, sf_dir)
        assert "Broadcast" not in v.scored(spark, sf_dir, again.classes)._jdf.queryExecution().executedPlan().toString()
        assert again.per_class.exceptAll(report.per_class).count() == 0
        assert again.per_class.count() == report.per_class.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_gain_is_measured_against_the_worst_member(scored):
    rows = {r.model: r for r in ops.member_scores(scored, v.members()).collect()}
    worst = min(r.f1_score for m, r in rows.items() if m != "final_prediction")
    assert rows["final_prediction"].gain_points == pytest.approx((rows["final_prediction"].f1_score - worst) * 100)
    assert rows["pred_0"].gain_points is None and len(rows) == v.MEMBERS + 1


def test_scored_rows_meet_one_shuffle_of_counts(spark, capsys):
    scored = spark.range(100).select((F.col("id") % 3).alias("label_index"), (F.col("id") % 2).alias("final_prediction"))
    ops.confusion_long(scored).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
