"""Confusion table and every measure that follows from it.

The scored table is read once, for the confusion table. All measures come from
its k x k rows instead of one pass per measure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowgauge.functions.measures import percent, ratio

OTHER = "other"


def confusion_long(scored: DataFrame, actual: str = "label_index", predicted: str = "final_prediction") -> DataFrame:
    """(label_index, final_prediction, count); combinations that never occur are absent."""
    return scored.groupBy(
        F.col(actual).alias("label_index"), F.col(predicted).alias("final_prediction")
    ).agg(F.count(F.lit(1)).alias("count"))


def class_totals(confusion: DataFrame, *by: str) -> DataFrame:
    """True positives, false positives and false negatives per class index.

    Each confusion row counts once for its actual and once for its predicted
    class, so one grouping gives row and column totals without a join.
    """
    hit = F.col("label_index") == F.col("final_prediction")
    n, none = F.col("count"), F.lit(0).cast("bigint")

    def part(index: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(F.col(index).alias("label_index"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))

    parts = F.array(
        part("label_index", F.when(hit, n).otherwise(none), none, F.when(hit, none).otherwise(n)),
        part("final_prediction", none, F.when(hit, none).otherwise(n), none),
    )
    return (
        confusion.select(*by, F.inline(parts))
        .groupBy(*by, "label_index")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    )


def _scores() -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def per_class_metrics(confusion: DataFrame, classes: DataFrame) -> DataFrame:
    """Percent precision, recall and f1 with tp, fp, fn of every class."""
    counted = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("tp", "fp", "fn")]
    joined = classes.join(class_totals(confusion), "label_index", "left").select("label", "label_index", *counted)
    return joined.select(
        "label",
        "label_index",
        *[percent(score).alias(name) for name, score in _scores().items()],
        "tp",
        "fp",
        "fn",
    )


def detection_rates(confusion: DataFrame, classes: DataFrame) -> DataFrame:
    """(label, taux): percent of a class's rows that were found, 0 if it has none."""
    found = confusion.groupBy("label_index").agg(
        F.sum("count").alias("total"),
        F.sum(F.when(F.col("label_index") == F.col("final_prediction"), F.col("count")).otherwise(0)).alias("correct"),
    )
    return classes.join(found, "label_index", "left").select(
        "label", percent(ratio(F.col("correct"), F.col("total"))).alias("taux")
    )


def global_metrics(confusion: DataFrame, *by: str) -> DataFrame:
    """Accuracy and support-weighted f1, precision and recall, as shares."""
    support = F.col("tp") + F.col("fn")
    weighted = [
        F.sum(score * support).alias(f"weighted_{name}") for name, score in _scores().items()
    ]
    totals = class_totals(confusion, *by)
    summed = (totals.groupBy(*by) if by else totals).agg(
        F.sum("tp").alias("correct"), F.sum(support).alias("total"), *weighted
    )
    total = F.col("total")
    return summed.select(
        *by,
        ratio(F.col("correct"), total).alias("accuracy"),
        ratio(F.col("weighted_f1"), total).alias("f1_score"),
        ratio(F.col("weighted_precision"), total).alias("precision"),
        ratio(F.col("weighted_recall"), total).alias("recall"),
    )


def rounded_metrics(metrics: DataFrame, digits: int = 4) -> DataFrame:
    return metrics.select(*[F.round(c, digits).alias(c) for c in ("accuracy", "f1_score", "precision", "recall")])


def metrics_table(metrics: DataFrame) -> DataFrame:
    """(metric, value) in percent."""
    # Metric names of the report table.
    names = {"Accuracy": "accuracy", "Precision": "precision", "Recall": "recall", "F1-Score": "f1_score"}
    rows = [F.struct(F.lit(n).alias("metric"), percent(F.col(c)).alias("value")) for n, c in names.items()]
    return metrics.select(F.inline(F.array(*rows)))


def named_confusion(confusion: DataFrame, classes: DataFrame) -> DataFrame:
    """Confusion table with class names; an unknown index shows as its number."""
    names = classes.select("label_index", "label")
    actual = names.select(F.col("label_index"), F.col("label").alias("actual"))
    predicted = names.select(F.col("label_index").alias("final_prediction"), F.col("label").alias("predicted"))
    return (
        confusion.join(actual, "label_index", "left")
        .join(predicted, "final_prediction", "left")
        .select(
            "label_index",
            "final_prediction",
            F.coalesce("actual", F.col("label_index").cast("int").cast("string")).alias("actual"),
            F.coalesce("predicted", F.col("final_prediction").cast("int").cast("string")).alias("predicted"),
            "count",
        )
    )


def confusion_matrix(confusion: DataFrame, classes: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per class, one column per predicted class, zeros filled in.

    Predictions of any other class are summed in a column OTHER, and rows of a
    class that the class table has not get a row of their own under their index,
    so the cells of a row always add up to its support.
    """
    named = named_confusion(confusion, classes)
    cells = [F.sum(F.when(F.col("predicted") == x, F.col("count"))).alias(x) for x in labels]
    other = F.sum(F.when(~F.col("predicted").isin(*labels), F.col("count"))).alias(OTHER)
    dense = named.groupBy("label_index", F.col("actual").alias("other_label")).agg(*cells, other)
    filled = [F.coalesce(F.col(f"`{x}`"), F.lit(0).cast("bigint")).alias(x) for x in (*labels, OTHER)]
    joined = classes.select("label", "label_index").join(dense, "label_index", "full")
    return joined.select(F.coalesce("label", "other_label").alias("label"), "label_index", *filled)


def prediction_scores(scored: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """(model, f1_score): weighted F1 of each prediction column, from one pass."""
    return pattern_scores(vote_patterns(scored, predictions), predictions)


def vote_patterns(scored: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """(label_index, the predictions, count): how often each pattern of predictions occurs.

    Counted on the map side, it is what every measure of these columns needs of
    the scored rows.
    """
    return scored.groupBy("label_index", *predictions).agg(F.count(F.lit(1)).alias("count"))


def pattern_scores(patterns: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """(model, f1_score) of each prediction column, from counted patterns."""
    cases = F.array(
        *[F.struct(F.lit(name).alias("model"), F.col(name).alias("final_prediction")) for name in predictions]
    )
    long = patterns.select("label_index", "count", F.inline(cases))
    counted = long.groupBy("model", "label_index", "final_prediction").agg(F.sum("count").alias("count"))
    return global_metrics(counted, "model").select("model", "f1_score")


def confusion_of_patterns(patterns: DataFrame, predicted: str = "final_prediction") -> DataFrame:
    """The confusion table of one prediction column, from counted patterns."""
    return patterns.groupBy("label_index", F.col(predicted).alias("final_prediction")).agg(F.sum("count").alias("count"))


def member_scores(scored: DataFrame, members: Sequence[str], vote: str = "final_prediction") -> DataFrame:
    """Weighted F1 of each member and of the vote, with the vote's gain in points."""
    return member_scores_of_patterns(vote_patterns(scored, [*members, vote]), members, vote)


def member_scores_of_patterns(patterns: DataFrame, members: Sequence[str], vote: str = "final_prediction") -> DataFrame:
    """The same from counted patterns.

    `gain_points` compares the vote with the worst member; it is null for members.
    """
    scores = pattern_scores(patterns, [*members, vote])
    worst = F.min(F.when(F.col("model") != vote, F.col("f1_score"))).over(W.partitionBy())
    gain = (F.col("f1_score") - worst) * 100.0
    return scores.select("model", "f1_score", F.when(F.col("model") == vote, gain).alias("gain_points"))
