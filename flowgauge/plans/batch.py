"""The whole batch job: CSV files to models, report tables and a run record."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, fields, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.operators import confusion as conf
from flowgauge.operators import forests
from flowgauge.operators.cleaning import clean, feature_columns, keep_labels, labelled
from flowgauge.operators.counting import fingerprint, label_counts
from flowgauge.operators.digests import digest_tree, write_tree
from flowgauge.operators.sampling import balance, split
from flowgauge.params import CleanParams, SampleParams, TrainParams
from flowgauge.plans.published import publish
from flowgauge.plans.runlog import StepLog, record_run
from flowgauge.sources.contract import require_schema
from flowgauge.sources.csv_files import infer_types, read_text_by_name, with_types
from flowgauge.sources.scratch import lookup, scratch_scope, written
from flowgauge.sources.tables import read_report, replace_table, write_metrics, write_reports

CORRUPT = "_corrupt_row"


@dataclass(frozen=True)
class BatchParams:
    """Settings of one batch run; `key` names the unique row key."""

    key: str = "flow_id"
    sample: SampleParams = field(default_factory=SampleParams)
    clean: CleanParams = field(default_factory=CleanParams)
    train: TrainParams = field(default_factory=TrainParams)
    search: bool = True
    strict_schema: bool = False
    multi_line: bool = False


@dataclass(frozen=True)
class BatchResult:
    """Folder of the run and its small tables."""

    path: str
    metrics: DataFrame
    per_class: DataFrame
    steps: DataFrame
    record: DataFrame


def prepare(raw: DataFrame, params: BatchParams) -> DataFrame:
    """All labelled and cleaned rows: the key, the label and the features."""
    rows = labelled(raw)
    if params.sample.keep_labels is not None:
        rows = keep_labels(rows, params.sample.keep_labels)
    return clean(rows, params.clean, keep=(params.key,))


def capped(train: DataFrame, params: BatchParams) -> DataFrame:
    """The training rows that fit the forests: at most a class's cap of each class."""
    return balance(train, params.sample.class_limits, params.key, params.sample.seed)


def params_as_text(params: BatchParams) -> dict[str, str]:
    """Every setting of a run, one JSON text for each field."""
    return {name: json.dumps(value, sort_keys=True) for name, value in asdict(params).items()}


def params_of_record(rows: Iterable[Row]) -> BatchParams:
    """The settings that a run record holds."""
    values = {r["name"]: json.loads(r["value"]) for r in rows if r["kind"] == "param"}
    parts = {"sample": SampleParams, "clean": CleanParams, "train": TrainParams}
    for name, kind in parts.items():
        values[name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values[name].items()})
    return BatchParams(**{f.name: values[f.name] for f in fields(BatchParams)})


def run_batch(
    spark: SparkSession, csv_path: str, out: str, params: BatchParams, schema: T.StructType | None = None
) -> BatchResult:
    """Ingest, clean, train, vote, evaluate and export.

    Class caps bound the rows that fit the forests and nothing else: all labelled
    rows are cleaned, split and counted, and the whole test side is scored. Each
    table that later steps read more than once is written first, so that nothing
    is computed twice and a lost executor costs no more than one step. Scratch
    tables go at the end of the run. The run counts as finished once its record
    is written, which is its last step; `plans.published` reads finished runs only.
    """
    if params.strict_schema and schema is None:
        raise ValueError("strict_schema needs a schema to hold the files against")
    run_id = uuid.uuid4().hex
    with scratch_scope(spark):
        return _run(spark, csv_path, out, run_id, params, schema)


def _run(
    spark: SparkSession, csv_path: str, out: str, run_id: str, params: BatchParams, schema: T.StructType | None
) -> BatchResult:
    base, log = f"{out}/{run_id}", StepLog()
    key, sample, train_params = params.key, params.sample, params.train

    with log.step("ingest") as step:
        text = written(read_text_by_name(spark, csv_path, CORRUPT, params.multi_line), "text")
        text.filter(F.col(CORRUPT).isNotNull()).write.parquet(f"{base}/bad_rows")
        whole = text.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        types = schema if schema is not None else infer_types(whole)
        if params.strict_schema:
            require_schema(text, types, CORRUPT)
        raw = replace_table(with_types(whole, types), f"{base}/raw")
        step.rows = raw.count()
    with log.step("prepare") as step:
        rows = written(prepare(raw, params), "prepared")
        features = feature_columns(rows, key)
        indexer = forests.fit_indexer(rows)
        data = forests.model_input(rows, features, indexer, key, train_params.layout)
        all_train, test = split(data, key, sample.test_share, sample.seed)
        train = written(capped(all_train, params), "train")
        numbers = spark.createDataFrame([(x, float(i)) for i, x in enumerate(indexer.labels)], "label string, label_index double")
        classes = lookup(numbers.join(label_counts(rows), "label").select("label", "label_index", "count"))
        step.rows = data.count()
    if params.search:
        with log.step("grid_search") as step:
            search = forests.grid_search(train, key, train_params)
            replace_table(search.scores, f"{base}/grid_scores")
            train_params = search.best
            step.rows = train.count()
    with log.step("ensemble") as step:
        models = forests.train_ensemble(train, train_params)
        best_model = search.model if params.search else models[0]
        step.rows = train.count()
    with log.step("vote") as step:
        members = forests.pred_columns(models)
        voted = forests.score_ensemble(test, models).select(key, "label", "label_index", *members, "final_prediction")
        voted = replace_table(voted, f"{base}/votes")
        patterns = written(conf.vote_patterns(voted, [*members, "final_prediction"]), "patterns")
        confusion = lookup(conf.confusion_of_patterns(patterns))
        metrics = conf.global_metrics(confusion)
        per_class = conf.per_class_metrics(confusion, classes)
        step.rows = voted.count()
    with log.step("save_models"):
        forests.save_members(models, indexer, features, f"{base}/models")
    with log.step("reports"):
        tables = {
            "feature_importance": forests.mean_importance(models, features, data),
            "label_counts": classes,
            "train_counts": label_counts(train),
            "conf_matrix": confusion,
            "metrics": conf.metrics_table(metrics),
            "metrics_wide": metrics,
            "detection_rates": conf.detection_rates(confusion, classes),
            "per_class_metrics": per_class,
            "member_scores": conf.member_scores_of_patterns(patterns, members),
        }
        if params.search:
            alone = written(best_model.transform(test).select("label_index", "prediction"), "best-model")
            of_best = conf.global_metrics(conf.confusion_long(alone, predicted="prediction"))
            tables["cv_metrics"] = conf.rounded_metrics(of_best)
            tested = of_best.select(
                F.lit(train_params.num_trees).alias("num_trees"), F.lit(train_params.max_depth).alias("max_depth"), F.col("f1_score").alias("f1")
            )
            tables["cv_gap"] = forests.score_gap(spark.read.parquet(f"{base}/grid_scores"), tested)
        write_reports(tables, f"{base}/reports")
        forests.prediction_export(test, best_model).write.parquet(f"{base}/predictions")
        record = write_metrics(conf.rounded_metrics(metrics), f"{base}/metrics")
    used = replace(params, train=replace(params.train, num_trees=train_params.num_trees, max_depth=train_params.max_depth))
    with log.step("record"):
        history = record_run(
            spark, f"{out}/runs", run_id, fingerprint(train.select(key, "label")), record.first().asDict(), params_as_text(used),
            steps=log.seconds(), finished=time.time_ns() // 1000,
        )
        write_tree(digest_tree(rows, key, [key, "label", *features]), f"{base}/digests")
    steps = replace_table(log.shares(spark), f"{base}/steps")
    publish(spark, out, run_id)
    found = history.filter(F.col("run_id") == run_id)
    return BatchResult(base, record, read_report(spark, f"{base}/reports", "per_class_metrics"), steps, found)
