"""Votes, confusion tables and the measures that follow from them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators import confusion as ops
from flowgauge.operators import counting, voting
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import F1, share, with_views
from flowgauge.sources.scratch import fresh_dir, written


@query("label_counts", with_views('select label, count(*) as "count" from flows group by label', "flows"))
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.label_counts(v.flows(spark, sf_dir))


@query("label_map", with_views("select label, label_index from classes", "classes"))
def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.class_table(v.flows(spark, sf_dir)).select("label", "label_index")


@query(
    "votes_wide",
    with_views(
        "select flow_id, "
        + ", ".join(f"max(pred) filter (where model = {i}) as pred_{i}" for i in range(v.MEMBERS))
        + " from members group by flow_id",
        "members",
    ),
)
def votes_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = v.scored(spark, sf_dir, v.classes(spark, sf_dir))
    apart = F.array(*[F.struct(F.lit(i).alias("model"), F.col(m).alias("pred")) for i, m in enumerate(v.members())])
    return voting.votes_wide(wide.select("flow_id", F.inline(apart)), v.KEY, v.MEMBERS)


@query(
    "votes_bucketed",
    with_views(
        "select flow_id, "
        + ", ".join(f"max(pred) filter (where model = {i}) as pred_{i}" for i in range(v.MEMBERS))
        + " from members group by flow_id having count(*) filter (where flow_id % 13 <> model) = 10",
        "members",
    ),
)
def votes_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The votes of members stored apart, each of which has left out some flows."""
    wide = _stored_scores(spark, sf_dir)
    names = []
    for i, member in enumerate(v.members()):
        names.append(f"member_{i}_{uuid.uuid4().hex}")
        rows = wide.where(F.col(v.KEY) % 13 != i).select(v.KEY, F.col(member).alias("prediction"))
        voting.write_votes(rows, names[-1], fresh_dir(spark, "member-votes"), v.KEY, v.DEALT)
    return voting.line_up_tables(spark, names, v.KEY)


def _stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members' predictions, scored once."""
    return written(v.scored(spark, sf_dir, v.classes(spark, sf_dir)), "scored")


@query(
    "majority_vote", with_views("select flow_id, label, label_index, final_prediction from voted", "voted")
)
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = v.voted(spark, sf_dir, v.classes(spark, sf_dir))
    return voted.select("flow_id", "label", "label_index", "final_prediction")


@query("confusion_long", with_views("select * from confusion", "confusion"))
def confusion_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.confusion_long(v.voted(spark, sf_dir, v.classes(spark, sf_dir)))


@query(
    "named_confusion",
    with_views(
        """select f.label_index, f.final_prediction, coalesce(a.label, f.label_index::int::varchar) as actual,
                  coalesce(p.label, f.final_prediction::int::varchar) as predicted, f."count"
           from confusion f left join classes a on a.label_index = f.label_index
           left join classes p on p.label_index = f.final_prediction""",
        "confusion",
    ),
)
def named_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return ops.named_confusion(report.confusion, report.classes)


@query(
    "confusion_matrix",
    with_views(
        "select c.label, c.label_index, "
        + ", ".join(
            f"""coalesce(sum(f."count") filter (where p.label = '{x}'), 0)::bigint as "{x}" """ for x in v.CLASSES
        )
        + """, coalesce(sum(f."count") filter (where p.label is null), 0)::bigint as other
              from classes c left join confusion f on f.label_index = c.label_index
              left join classes p on p.label_index = f.final_prediction group by c.label, c.label_index""",
        "confusion",
    ),
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return ops.confusion_matrix(report.confusion, report.classes, v.CLASSES)


@query("per_class_metrics", with_views("select * from per_class", "per_class"))
def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.Report(spark, sf_dir).per_class


@query(
    "detection_rates",
    with_views(f"""select label, round({share("tp", "tp + fn")} * 100.0, 2) as taux from totals""", "totals"),
)
def detection_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = v.Report(spark, sf_dir)
    return ops.detection_rates(report.confusion, report.classes)


_METRICS = ("accuracy", "f1_score", "precision", "recall")


@query(
    "global_metrics",
    with_views("select " + ", ".join(f'round("{m}", 9) as "{m}"' for m in _METRICS) + " from metrics", "metrics"),
)
def global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rounded_metrics(v.Report(spark, sf_dir).metrics, 9)


@query(
    "metrics_table",
    with_views(
        """select 'Accuracy' as metric, round(accuracy * 100.0, 2) as value from metrics
           union all select 'Precision', round("precision" * 100.0, 2) from metrics
           union all select 'Recall', round(recall * 100.0, 2) from metrics
           union all select 'F1-Score', round(f1_score * 100.0, 2) from metrics""",
        "metrics",
    ),
)
def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.metrics_table(v.Report(spark, sf_dir).metrics)


@query(
    "member_vs_ensemble",
    with_views(
        f""", every as (
               select 'pred_' || model as model, label_index, pred from members
               union all select 'final_prediction', label_index, final_prediction from voted),
             pairs as (select model, label_index, pred, count(*) as n from every group by all),
             per_model as (
               select m.model, c.label_index,
                      coalesce(sum(n) filter (where p.label_index = c.label_index and p.pred = c.label_index), 0) as tp,
                      coalesce(sum(n) filter (where p.label_index <> c.label_index and p.pred = c.label_index), 0) as fp,
                      coalesce(sum(n) filter (where p.label_index = c.label_index and p.pred <> c.label_index), 0) as fn
               from (select distinct model from pairs) m cross join classes c
               left join pairs p on p.model = m.model and (p.label_index = c.label_index or p.pred = c.label_index)
               group by all),
             f1s as (select model, sum({F1} * (tp + fn)) / sum(tp + fn) as f1_score from per_model group by model)
             select model, round(f1_score, 9) as f1_score,
                    case when model = 'final_prediction' then round((f1_score - (
                      select min(f1_score) from f1s where model <> 'final_prediction')) * 100.0, 6) end as gain_points
             from f1s""",
        "members",
        "voted",
    ),
)
def member_vs_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    voted = v.voted(spark, sf_dir, v.classes(spark, sf_dir))
    return ops.member_scores(voted, v.members()).select(
        "model", F.round("f1_score", 9).alias("f1_score"), F.round("gain_points", 6).alias("gain_points")
    )
