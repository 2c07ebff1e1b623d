from __future__ import annotations

import os
import subprocess
import sys
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import confusion, forests
from flowgauge.operators.sampling import split, with_fold
from flowgauge.params import CleanParams
from flowgauge.plans.batch import BatchParams, SampleParams, params_of_record, run_batch
from flowgauge.plans.reports import report_views
from flowgauge.registry import modelling, streaming
from flowgauge.registry import views as v
from flowgauge.sources.contract import SchemaMismatch
from flowgauge.sources.scratch import fresh_dir, scratch_base
from flowgauge.sources.tables import REPORT_TABLES, read_report
from flowgauge.streaming import alerts


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return modelling.Prepared(spark, sf_dir)


@pytest.fixture(scope="module")
def models(data):
    return forests.train_ensemble(data.train, v.TRAIN)


def test_members_differ_by_seed_and_repeat(data, models):
    def trees(fitted):
        return [m.toDebugString.split("\n", 1)[1] for m in fitted]

    assert trees(forests.train_ensemble(data.train, v.TRAIN)) == trees(models)
    assert len(set(trees(models))) == v.TRAIN.n_models


_FIT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[{cores}]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.files.maxPartitionBytes", "{split}").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
from flowgauge.operators import confusion, forests
from flowgauge.registry import modelling, views as v
model = forests.train_one(modelling.Prepared(spark, {sf_dir!r}).train, v.TRAIN)
print("TREES", hash_of(model))
""".replace("hash_of(model)", "__import__('hashlib').md5(model.toDebugString.split('\\n', 1)[1].encode()).hexdigest()")


def test_forests_do_not_depend_on_cores(sf_dir):
    """Two processes with other cores and read splits fit the same trees."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = set()
    for cores, size in ((2, "128m"), (4, "8k")):
        code = _FIT.format(root=root, cores=cores, split=size, sf_dir=sf_dir)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=300)
        found |= {line for line in done.stdout.splitlines() if line.startswith("TREES")}
        assert found, done.stderr[-2000:]
    assert len(found) == 1


def test_forests_do_not_depend_on_the_input_order(spark, sf_dir, data, models):
    rows = modelling.feature_rows(spark, sf_dir).repartition(5).orderBy(F.desc("value"))
    again = forests.model_input(rows, v.FEATURES, data.indexer, v.KEY, v.TRAIN.layout)
    train = split(again, v.KEY, v.TEST_SHARE, v.SEED)[0]
    refitted = forests.train_one(train, v.TRAIN)
    assert refitted.toDebugString.split("\n", 1)[1] == models[0].toDebugString.split("\n", 1)[1]


def test_features_are_parsed_once(spark, sf_dir, data, capsys):
    data.rows.explain()
    assert "get_json_object" not in capsys.readouterr().out
    assert data.rows.exceptAll(modelling.feature_rows(spark, sf_dir)).count() == 0
    assert data.rows.count() == data.table.count() > 0


def test_members_learn_something(data, models):
    scored = forests.score_ensemble(data.test, models)
    right = scored.filter("label_index = final_prediction").count()
    assert right / scored.count() > 0.8
    assert "rawPrediction" not in scored.columns and "probability" not in scored.columns


def test_unseen_labels_are_errors_in_training_and_skipped_in_scoring(spark, data):
    odd = spark.createDataFrame([("benign",), ("unheard of",)], "label string")
    with pytest.raises(Exception, match="(?i)unseen"):
        data.indexer.transform(odd).collect()
    assert forests.for_scoring(data.indexer).transform(odd).count() == 1


def test_index_ties_go_by_name(spark):
    df = spark.createDataFrame([(x,) for x in "bacc"], "label string")
    assert list(forests.fit_indexer(df).labels) == ["c", "a", "b"]


def test_best_params_prefer_the_smaller_forest(spark):
    scores = spark.createDataFrame([(10, 5, 0.9), (5, 5, 0.9), (5, 3, 0.8)], "num_trees int, max_depth int, f1 double")
    assert tuple(forests.best_params(scores).first()) == (5, 5, 0.9)


def test_grid_scores_equal_the_cross_validator(data):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    ours = forests.grid_search(data.train, v.KEY, v.TRAIN)
    rf = forests.forest(v.TRAIN, v.TRAIN.seed)
    grid = ParamGridBuilder().addGrid(rf.numTrees, [5, 10]).addGrid(rf.maxDepth, [3, 5]).build()
    evaluator = MulticlassClassificationEvaluator(labelCol="label_index", metricName="f1")
    theirs = CrossValidator(
        estimator=rf, estimatorParamMaps=grid, evaluator=evaluator, numFolds=v.TRAIN.n_folds, foldCol="fold"
    ).fit(forests.arranged(with_fold(data.train, v.KEY, v.TRAIN.n_folds, v.TRAIN.seed), v.TRAIN.layout))
    expected = {
        tuple({p.name: x for p, x in point.items()}[n] for n in ("numTrees", "maxDepth")): score
        for point, score in zip(grid, theirs.avgMetrics)
    }
    got = {(r.num_trees, r.max_depth): r.f1 for r in ours.scores.collect()}
    assert got == pytest.approx(expected, abs=1e-9)
    assert (ours.best.num_trees, ours.best.max_depth) == tuple(forests.best_params(ours.scores).first())[:2]
    assert ours.model.getNumTrees == ours.best.num_trees


def test_importances_sum_to_one(data, models):
    rows = forests.mean_importance(models, v.FEATURES, data.train).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1)
    assert rows[0].feature == "value" and {r.feature for r in rows} == set(v.FEATURES)


def test_probabilities_are_one_per_class(data, models):
    row = forests.prediction_export(data.test, models[0]).first()
    assert len(row.probability) == len(v.CLASSES) and sum(row.probability) == pytest.approx(1)


def test_stream_equals_batch(spark, sf_dir, data, models):
    rows = modelling.feature_rows(spark, sf_dir)
    ready = forests.assembler(v.FEATURES).transform(rows)
    batch = forests.score_ensemble(ready, models).select("flow_id", "label", "final_prediction")
    stream = alerts.read_flow_stream(spark, streaming.arriving(rows, spark), rows.schema, 1)
    scored = alerts.score_stream(stream, models, forests.assembler(v.FEATURES), v.KEY, ("label",))
    benign = alerts.benign_index(data.indexer.labels, v.BENIGN)
    found = alerts.alerts(scored.select("flow_id", "label", "final_prediction"), benign)
    out = alerts.run_to_files(found, fresh_dir(spark, "a"), fresh_dir(spark, "p"))
    expected = alerts.alerts(batch, benign)
    assert expected.count() > 0
    assert out.exceptAll(expected).count() == 0 and expected.exceptAll(out).count() == 0


def test_alerts_predict_each_member_once(spark, sf_dir, models, capsys):
    rows = modelling.feature_rows(spark, sf_dir)
    scored = alerts.score_stream(rows, models, forests.assembler(v.FEATURES), v.KEY)
    alerts.alerts(scored, 0.0).select("flow_id").explain()
    assert capsys.readouterr().out.count("UDF(features") == len(models)


def test_unequal_keys_count_repeats_and_nulls(spark):
    found = spark.createDataFrame([(1,), (2,), (2,), (None,)], "flow_id long")
    expected = spark.createDataFrame([(2,), (1,), (3,), (None,)], "flow_id long")
    assert {tuple(r) for r in streaming.unequal_keys(found, expected).collect()} == {(2, 1), (3, -1)}
    assert streaming.unequal_keys(found, found).count() == 0


def test_stream_takes_up_where_it_stopped(spark, tmp_path):
    src, out, progress = (str(tmp_path / d) for d in ("src", "out", "progress"))
    schema = "flow_id long, final_prediction double"
    for n in (2, 3):
        spark.range(n).selectExpr("id as flow_id", "1.0D as final_prediction").coalesce(1).write.mode("append").parquet(src)
        stream = alerts.read_flow_stream(spark, src, spark.read.schema(schema).parquet(src).schema)
        found = alerts.run_to_files(alerts.alerts(stream, 0.0), out, progress)
    assert found.count() == 5


def test_benign_class_must_be_known():
    with pytest.raises(ValueError, match="ok"):
        alerts.benign_index(["a", "b"], "ok")


def test_batch_run_end_to_end(spark, sf_dir, tmp_path):
    params = BatchParams(
        sample=SampleParams(class_limits=v.CAPS),
        clean=CleanParams(cast_columns=("duration", "packets_count", "src_port")),
        train=v.TRAIN,
    )
    csv = modelling.raw_csv(spark, sf_dir)
    before = set(os.listdir(scratch_base(spark).removeprefix("file:")))
    result = run_batch(spark, csv, str(tmp_path), params, modelling._RAW)
    for name in REPORT_TABLES:
        assert read_report(spark, f"{result.path}/reports", name).count() > 0
    votes = spark.read.parquet(f"{result.path}/votes")
    assert sum(r.tp + r.fn for r in result.per_class.collect()) == votes.count()
    assert spark.read.parquet(f"{result.path}/grid_scores").count() == 4
    assert result.metrics.first().accuracy > 0.6
    assert "accuracy" in {r.name for r in result.record.collect()}
    _, _, loaded = forests.load_members(f"{result.path}/models")
    assert len(loaded) == v.TRAIN.n_models
    steps = {r.step: r for r in result.steps.collect()}
    assert sum(r.percent for r in steps.values()) == pytest.approx(100, abs=0.01)
    assert steps["vote"].rows == votes.count() and steps["vote"].rows_per_second > 0
    assert read_report(spark, f"{result.path}/reports", "cv_metrics").first().accuracy > 0.6
    gap = read_report(spark, f"{result.path}/reports", "cv_gap").first()
    assert gap.gap_points == pytest.approx((gap.cv_f1 - gap.test_f1) * 100)
    used = params_of_record(result.record.collect())
    best = (used.train.num_trees, used.train.max_depth)
    assert best == (gap.num_trees, gap.max_depth)
    assert replace(used, train=replace(used.train, num_trees=v.TRAIN.num_trees, max_depth=v.TRAIN.max_depth)) == params
    views = report_views(spark, result.path, v.REPORT, 1, v.CHOICE)
    assert all(view.count() > 0 for view in views.values()) and len(views) == 16
    assert not [d for d in os.listdir(scratch_base(spark).removeprefix("file:")) if d.startswith(("prepared-", "model-input-")) and d not in before]
    with pytest.raises(SchemaMismatch, match="packets_count"):
        run_batch(spark, csv, str(tmp_path), BatchParams(strict_schema=True), modelling._RAW)
    with pytest.raises(ValueError, match="needs a schema"):
        run_batch(spark, csv, str(tmp_path), BatchParams(strict_schema=True))


def test_caps_bound_the_fit_only(spark, sf_dir, tmp_path):
    params = replace(modelling.BATCH, search=False, train=replace(v.TRAIN, n_models=1, num_trees=2))
    result = run_batch(spark, modelling.raw_csv(spark, sf_dir), str(tmp_path), params, modelling._RAW)
    reports = f"{result.path}/reports"
    all_rows = {r["label"]: r["count"] for r in read_report(spark, reports, "label_counts").collect()}
    train = {r["label"]: r["count"] for r in read_report(spark, reports, "train_counts").collect()}
    tested = {r["label"]: r["tp"] + r["fn"] for r in result.per_class.collect()}
    assert {c: tested[c] + train[c] for c in all_rows if c not in v.CAPS} == {c: n for c, n in all_rows.items() if c not in v.CAPS}
    small = replace(params, sample=replace(params.sample, class_limits={"benign": 20}))
    again = run_batch(spark, modelling.raw_csv(spark, sf_dir), str(tmp_path), small, modelling._RAW)
    assert {r["label"]: r["tp"] + r["fn"] for r in again.per_class.collect()} == tested
    assert {r["label"]: r["count"] for r in read_report(spark, f"{again.path}/reports", "train_counts").collect()}["benign"] == 20


def test_rows_without_label_or_other_columns_are_scored(spark, data, models):
    live = spark.createDataFrame(
        [(1, None, "5.0", 1.0, 2, 3.0, None), (2, None, "inf", None, 2, 3.0, "x"), (3, "flood", "x", 1.0, 2, 3.0, "y")],
        "flow_id long, label string, value string, k double, hour int, user double, src_ip string",
    )
    vector = forests.assembler(v.FEATURES)
    scored = alerts.score_stream(live, models, vector, v.KEY, ("src_ip",)).collect()
    assert [(r.flow_id, r.src_ip) for r in scored] == [(1, None)] and scored[0].final_prediction is not None
    reasons = {r.flow_id: r.reason for r in alerts.rejected(live, vector, v.KEY).collect()}
    assert reasons == {2: "value,k", 3: "value"}
    with pytest.raises(ValueError, match="columns missing in the stream: hour"):
        alerts.score_stream(live.drop("hour"), models, vector, v.KEY)


def test_members_are_counted_by_the_manifest(spark, data, models, tmp_path):
    forests.save_members(models[:2], data.indexer, v.FEATURES, str(tmp_path / "m"))
    assert len(forests.load_members(str(tmp_path / "m"))[2]) == 2


def test_scores_read_the_folds_once_and_count_patterns_first(data, models):
    names = forests.pred_columns(models)
    scored = forests.score_ensemble(data.test, models)
    plan = confusion.member_scores(scored, names)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.rindex("HashAggregate")  # rows are counted before they are multiplied
