"""Report tables behind the charts.

Their inputs hold one row per class or per pair of classes, already counted, so
windows without a partition run over that many rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from flowgauge.functions.measures import band, grouped, ratio, two_decimals
from flowgauge.operators.confusion import named_confusion
from flowgauge.params import (
    QUALITY_BANDS, QUALITY_REST, SCORE_BANDS, SCORE_REST, VOLUME_BANDS, VOLUME_REST, ReportParams,
)
from flowgauge.sources.tables import read_report

ALL = "ALL"


def _whole() -> WindowSpec:
    """All rows of an already counted table."""
    return W.partitionBy()


def selected(choice: str | None, label: str = "label") -> Column:
    """True for the chosen class, or for every class where none is chosen."""
    return F.lit(True) if choice in (None, "", ALL) else F.col(label) == choice


def kpi_summary(counts: DataFrame, per_class: DataFrame, metrics: DataFrame, params: ReportParams) -> DataFrame:
    """Totals, attack types, false positives, accuracy and F1 in one row."""
    attack = F.col("label") != params.benign
    volume = counts.agg(
        F.sum("count").alias("total_flows"),
        F.coalesce(F.sum(F.when(attack, F.col("count"))), F.lit(0)).alias("total_attacks"),
        F.count(F.lit(1)).alias("classes"),
        F.array_join(F.array_sort(F.collect_list(F.when(attack, F.col("label")))), ", ").alias("attack_types"),
        F.count_if(attack).alias("attack_type_count"),
    )
    misses = per_class.agg(F.coalesce(F.sum("fp"), F.lit(0)).alias("false_positives"))
    shares = metrics.select(
        F.round(F.col("accuracy") * 100.0, 2).alias("accuracy"), F.round(F.col("f1_score") * 100.0, 2).alias("f1")
    )
    return _side_by_side(volume, misses, shares)


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def worst_class(per_class: DataFrame) -> DataFrame:
    """The class with the lowest F1; the first by index on ties."""
    worst = F.min_by(F.struct("label", "f1", "precision", "recall", "fn"), F.struct("f1", "label_index"))
    return per_class.agg(worst.alias("worst")).select("worst.*")


def volume_bands(counts: DataFrame, params: ReportParams, choice: str | None = None) -> DataFrame:
    """Attack volume, smallest first, banded by its share of the largest."""
    share = ratio(F.col("count"), F.max("count").over(_whole()))
    return (
        counts.filter(F.col("label") != params.benign)
        .withColumn("share", share)
        .select(
            "label",
            "count",
            band(F.col("share"), VOLUME_BANDS, VOLUME_REST, inclusive=False).alias("band"),
            selected(choice).alias("selected"),
        )
        .orderBy("count", "label")
    )


def metric_bands(per_class: DataFrame, params: ReportParams, metric: str = "f1", choice: str | None = None) -> DataFrame:
    """One metric per class, lowest first, with band, target flag and axis floor."""
    value = F.col(metric)
    return per_class.select(
        "label",
        value.alias("value"),
        band(value, SCORE_BANDS, SCORE_REST, inclusive=True).alias("band"),
        (value < params.target_score).alias("below_target"),
        F.greatest(F.lit(0.0), F.min(value).over(_whole()) - params.axis_margin).alias("axis_floor"),
        selected(choice).alias("selected"),
    ).orderBy("value", "label")


def pr_points(per_class: DataFrame, counts: DataFrame, params: ReportParams, choice: str | None = None) -> DataFrame:
    """Precision and recall points with volume, marker size and target zone."""
    volume = F.coalesce(F.col("count"), F.lit(params.default_volume).cast("bigint"))
    joined = per_class.join(counts.select("label", "count"), "label", "left").withColumn("volume", volume)
    size = params.min_point + params.point_range * ratio(F.col("volume"), F.max("volume").over(_whole()))
    target = params.target_score
    return joined.select(
        "label",
        "precision",
        "recall",
        "f1",
        "fn",
        "volume",
        F.round(size, 6).alias("size"),
        band(F.col("f1"), SCORE_BANDS, SCORE_REST, inclusive=True).alias("band"),
        ((F.col("precision") >= target) & (F.col("recall") >= target)).alias("ideal"),
        selected(choice).alias("selected"),
    )


def confusion_heat(confusion: DataFrame, classes: DataFrame) -> DataFrame:
    """Every cell of the confusion matrix with its log value and cell text.

    Rows and columns are the class indices that occur as such; the grid of both
    has k x k cells, as many as the matrix that is drawn.
    """
    by_actual = confusion.groupBy("label_index").agg(
        F.map_from_entries(F.collect_list(F.struct("final_prediction", "count"))).alias("cells")
    )
    predicted = confusion.agg(F.collect_set("final_prediction")).scalar()
    grid = by_actual.select("label_index", "cells", F.explode(predicted).alias("final_prediction")).select(
        "label_index",
        "final_prediction",
        F.coalesce(F.try_element_at("cells", F.col("final_prediction")), F.lit(0).cast("bigint")).alias("count"),
    )
    n = F.col("count")
    text = F.when(n >= 1000, F.concat(F.floor(n / 1000).cast("string"), F.lit("K"))).when(n > 0, n.cast("string"))
    return named_confusion(grid, classes).select(
        "actual",
        "predicted",
        "count",
        F.round(F.log1p(n.cast("double")), 6).alias("heat"),
        F.coalesce(text, F.lit("")).alias("cell_text"),
    )


def top_importances(importances: DataFrame, k: int) -> DataFrame:
    """The k largest importances, smallest of them first."""
    return importances.orderBy(F.desc("importance"), "feature").limit(k).orderBy("importance", "feature")


def radar_profile(per_class: DataFrame, params: ReportParams, choice: str | None = None) -> DataFrame:
    """F1, precision and recall of one class, or the mean where it is unknown."""
    names = ("f1", "precision", "recall")
    chosen = F.lit(False) if choice in (None, "", ALL) else F.col("label") == choice
    row = per_class.agg(
        F.count_if(chosen).alias("found"),
        *[F.coalesce(F.max(F.when(chosen, F.col(n))), F.avg(n)).alias(n) for n in names],
    )
    floor = F.greatest(F.lit(params.radar_floor), F.least(*names) - params.radar_margin)
    title = F.when(F.col("found") > 0, F.lit(choice)).otherwise(F.lit("mean"))
    return row.select(
        title.alias("title"), *[F.round(n, 6).alias(n) for n in names], F.round(floor, 6).alias("axis_floor")
    )


def drilldown(per_class: DataFrame, choice: str | None = None) -> DataFrame:
    """Class table, best F1 first, with a quality band."""
    return (
        per_class.filter(selected(choice))
        .select(
            "label", "f1", "precision", "recall", "tp", "fp", "fn",
            band(F.col("f1"), QUALITY_BANDS, QUALITY_REST, inclusive=True).alias("quality"),
        )
        .orderBy(F.desc("f1"), "label")
    )


def filter_options(counts: DataFrame, params: ReportParams) -> DataFrame:
    """ALL, then the attack types by name."""
    types = counts.filter(F.col("label") != params.benign).select(F.lit(1).alias("rank"), F.col("label").alias("value"))
    every = counts.sparkSession.createDataFrame([(0, ALL)], types.schema)
    return every.unionByName(types).orderBy("rank", "value").select("value")


def threat_context(per_class: DataFrame, choice: str) -> DataFrame:
    """One class's figures as text lines, for a written analysis."""
    return per_class.filter(F.col("label") == choice).select(
        F.col("label").alias("attack_type"),
        F.concat(two_decimals(F.col("f1")), F.lit("%")).alias("f1_text"),
        F.concat(two_decimals(F.col("precision")), F.lit("%")).alias("precision_text"),
        F.concat(two_decimals(F.col("recall")), F.lit("%")).alias("recall_text"),
        grouped(F.col("fn")).alias("missed_text"),
    )


def briefing_context(kpis: DataFrame, per_class: DataFrame) -> DataFrame:
    """Totals as text and one line per class, weakest first."""
    weakest_first = F.array_sort(F.collect_list(F.struct("f1", "label_index", "label", "fn")))
    lines = F.transform(
        weakest_first,
        lambda c: F.concat(
            F.lit("- "), c["label"], F.lit(": F1="), two_decimals(c["f1"]), F.lit("%, FN="), c["fn"].cast("string")
        ),
    )
    return _side_by_side(_kpi_texts(kpis), per_class.agg(F.array_join(lines, "\n").alias("class_lines")))


def critical_classes(per_class: DataFrame, params: ReportParams, many_missed: int) -> DataFrame:
    """Classes below the target F1 or with at least `many_missed` misses."""
    weak = (F.col("f1") < params.target_score) | (F.col("fn") >= many_missed)
    return per_class.filter(weak).select("label", "f1", "fn").orderBy("f1", "label")


def chat_context(kpis: DataFrame, counts: DataFrame, params: ReportParams) -> DataFrame:
    """Totals as text and the attack types, most frequent first."""
    attack = F.when(F.col("label") != params.benign, F.struct((-F.col("count")).alias("n"), F.col("label").alias("label")))
    ordered = F.transform(F.array_sort(F.collect_list(attack)), lambda c: c["label"])
    return _side_by_side(_kpi_texts(kpis), counts.agg(F.array_join(ordered, ", ").alias("attack_types")))


def _kpi_texts(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        grouped(F.col("total_flows")).alias("flows_text"),
        grouped(F.col("total_attacks")).alias("attacks_text"),
        F.concat(two_decimals(F.col("accuracy")), F.lit("%")).alias("accuracy_text"),
        F.concat(two_decimals(F.col("f1")), F.lit("%")).alias("f1_text"),
    )


def as_long(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    """Report tables as (table, item, measure, value) rows."""
    parts = []
    for name, table in tables.items():
        item = F.concat_ws("/", *[_key_text(table, k) for k in keys[name]])
        measures = [c for c in table.columns if c not in keys[name]]
        cells = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
        parts.append(table.select(F.lit(name).alias("table"), item.alias("item"), F.inline(F.array(*cells))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _key_text(table: DataFrame, name: str) -> Column:
    column = F.col(name)
    return (column.cast("int") if dict(table.dtypes)[name] == "double" else column).cast("string")


def report_views(
    spark: SparkSession, base: str, params: ReportParams, many_missed: int, choice: str | None = None
) -> dict[str, DataFrame]:
    """Every report view of a run, from the report tables below its folder."""
    counts, per_class, confusion, metrics, importances = (
        read_report(spark, f"{base}/reports", name)
        for name in ("label_counts", "per_class_metrics", "conf_matrix", "metrics_wide", "feature_importance")
    )
    kpis = kpi_summary(counts, per_class, metrics, params)
    views = {
        "kpi_summary": kpis,
        "worst_class": worst_class(per_class),
        "volume_bands": volume_bands(counts, params, choice),
        "pr_points": pr_points(per_class, counts, params, choice),
        "confusion_heat": confusion_heat(confusion, counts),
        "top_features": top_importances(importances, params.top_features),
        "radar_profile": radar_profile(per_class, params, choice),
        "drilldown": drilldown(per_class, choice),
        "filter_options": filter_options(counts, params),
        "briefing_context": briefing_context(kpis, per_class),
        "critical_classes": critical_classes(per_class, params, many_missed),
        "chat_context": chat_context(kpis, counts, params),
    }
    views |= {f"{m}_bands": metric_bands(per_class, params, m, choice) for m in ("f1", "precision", "recall")}
    if choice not in (None, "", ALL):
        views["threat_context"] = threat_context(per_class, choice)
    return views
