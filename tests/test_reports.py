from __future__ import annotations

import pytest

from flowgauge.operators import confusion as conf
from flowgauge.params import ReportParams
from flowgauge.plans import reports, runlog
from flowgauge.registry import views as v
from flowgauge.sources.tables import MissingReport, read_report, write_reports

PARAMS = ReportParams(benign="ok")


@pytest.fixture(scope="module")
def per_class(spark):
    return spark.createDataFrame(
        [("ok", 0.0, 99.5, 99.0, 99.0, 990, 5, 10), ("a", 1.0, 96.0, 60.0, 74.0, 60, 3, 40), ("b", 2.0, 98.0, 98.0, 74.0, 9, 1, 1)],
        "label string, label_index double, precision double, recall double, f1 double, tp long, fp long, fn long",
    )


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame([("ok", 2000), ("a", 100)], "label string, count long")


def test_first_of_equally_weak_classes(per_class):
    assert reports.worst_class(per_class).first().label == "a"


def test_missing_volume_has_a_default(per_class, counts):
    points = {r.label: r for r in reports.pr_points(per_class, counts, PARAMS).collect()}
    assert points["b"].volume == 1000 and points["ok"].size == 60.0
    assert points["b"].ideal and not points["a"].ideal and points["a"].selected


@pytest.mark.parametrize("choice, title, f1", [("a", "a", 74.0), ("zzz", "mean", 82.333333), ("ALL", "mean", 82.333333), (None, "mean", 82.333333)])
def test_radar_falls_back_to_the_mean(per_class, choice, title, f1):
    row = reports.radar_profile(per_class, PARAMS, choice).first()
    assert (row.title, row.f1) == (title, f1)
    assert row.axis_floor == 70.0 or choice != "a"


def test_axis_floor_is_not_negative(spark, per_class):
    assert reports.metric_bands(per_class, PARAMS, "recall").first().axis_floor == 57.0
    low = per_class.selectExpr("label", "1.0D as recall")
    assert reports.metric_bands(low, PARAMS, "recall").first().axis_floor == 0.0


def test_bands_at_their_bounds(spark):
    rows = spark.createDataFrame([(f"{x}", x) for x in (99.0, 97.0, 95.0, 93.0, 92.99)], "label string, f1 double")
    assert [r.band for r in reports.metric_bands(rows, PARAMS).collect()] == ["critical", "weak", "fair", "good", "excellent"]
    volumes = spark.createDataFrame([("a", 100), ("b", 60), ("c", 61), ("d", 5), ("ok", 10**6)], "label string, count long")
    bands = {r.label: r.band for r in reports.volume_bands(volumes, PARAMS).collect()}
    assert bands == {"a": "critical", "c": "critical", "b": "high", "d": "minimal"}


def test_heat_text(spark):
    classes = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "label string, label_index double")
    confusion = spark.createDataFrame(
        [(0.0, 0.0, 12999), (0.0, 1.0, 999), (1.0, 1.0, 1000)], "label_index double, final_prediction double, count long"
    )
    cells = {(r.actual, r.predicted): r.cell_text for r in reports.confusion_heat(confusion, classes).collect()}
    assert cells == {("a", "a"): "12K", ("a", "b"): "999", ("b", "b"): "1K", ("b", "a"): ""}


def test_drilldown_order_and_filter(per_class):
    assert [r.quality for r in reports.drilldown(per_class).collect()] == ["green", "red", "red"]
    assert [r.label for r in reports.drilldown(per_class, "b").collect()] == ["b"]


def test_options_and_context(spark, per_class, counts):
    assert [r.value for r in reports.filter_options(counts, PARAMS).collect()] == ["ALL", "a"]
    metrics = spark.createDataFrame([(0.9912, 0.985, 0.9, 0.9912)], "accuracy double, f1_score double, precision double, recall double")
    kpis = reports.kpi_summary(counts, per_class, metrics, PARAMS)
    row = kpis.first()
    assert (row.total_flows, row.total_attacks, row.classes, row.false_positives, row.accuracy) == (2100, 100, 2, 9, 99.12)
    briefing = reports.briefing_context(kpis, per_class).first()
    assert briefing.flows_text == "2,100" and briefing.f1_text == "98.50%"
    assert briefing.class_lines.split("\n")[0] == "- a: F1=74.00%, FN=40"
    assert reports.chat_context(kpis, counts, PARAMS).first().attack_types == "a"
    assert reports.threat_context(per_class, "ok").first().missed_text == "10"
    assert [r.label for r in reports.critical_classes(per_class, PARAMS, 10).collect()] == ["a", "b", "ok"]


def test_missing_report_is_an_error(spark, tmp_path, counts):
    with pytest.raises(MissingReport, match="label_counts"):
        read_report(spark, str(tmp_path), "label_counts")
    write_reports({"label_counts": counts}, str(tmp_path))
    write_reports({"label_counts": counts.limit(1)}, str(tmp_path))
    assert read_report(spark, str(tmp_path), "label_counts").count() == 1


def test_step_log(spark):
    log = runlog.StepLog()
    with log.step("read", 10):
        pass
    total = spark.createDataFrame([(log.elapsed() + 1.0,)], "total double")
    rows = {r.step: r for r in runlog.step_shares(log.table(spark), total).collect()}
    assert set(rows) == {"read", runlog.EXPORT}
    assert sum(r.percent for r in rows.values()) == pytest.approx(100, abs=0.01)


def test_run_records_add_up(spark, tmp_path):
    data = spark.createDataFrame([(3, "17")], "rows long, digest string")
    path = str(tmp_path / "runs")
    runlog.record_run(spark, path, "r1", data, {"accuracy": 0.5}, {"seed": 1})
    runs = runlog.record_run(spark, path, "r2", data, {"accuracy": 0.6}, {"seed": 1})
    assert runs.filter("run_id = 'r2' and name = 'accuracy'").first().value == "0.6"
    assert runs.count() == 8


def test_report_tables_hold_all_classes(spark, sf_dir):
    report = v.Report(spark, sf_dir)
    assert {r.label for r in conf.detection_rates(report.confusion, report.classes).collect()} == set(v.CLASSES)
