"""Two versions of a training set, published runs and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators import confusion, counting, digests
from flowgauge.plans import history, published, runlog
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import F1, with_views
from flowgauge.sources.scratch import fresh_dir, written
from flowgauge.sources.tables import write_reports

COLUMNS = ("flow_id", "user_id", "value_txt", "label")
LEAVES = 1 << digests.BITS


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The dirty flows, and a later delivery of them: some changed, some gone, some new."""
    before = v.dirty(spark, sf_dir).select(*COLUMNS)
    place = F.col("flow_id") % 1499
    later = before.where(place != 7).withColumn("value_txt", F.when(place == 11, F.lit("-1")).otherwise(F.col("value_txt")))
    new = before.where(place == 13).withColumn("flow_id", -F.col("flow_id") - 1)
    return before, later.unionByName(new)


_BEFORE = "before as (select flow_id, user_id, value_txt, label from dirty)"
_AFTER = """after as (
    select flow_id, user_id, case when flow_id % 1499 = 11 then '-1' else value_txt end as value_txt, label
    from before where flow_id % 1499 <> 7
    union all select -flow_id - 1, user_id, value_txt, label from before where flow_id % 1499 = 13)"""
_LEAF = f"('0x' || substr(md5('digest-tree:' || flow_id), 1, 8))::bigint // {2**32 // LEAVES}"


@query(
    "fingerprint_diff",
    with_views("", "dirty").rstrip() + f""", {_BEFORE}, {_AFTER},
        differing as ((select * from before except all select * from after) union all (select * from after except all select * from before)),
        leaves as (select distinct {_LEAF} as bucket from differing)
        select l.bucket::int as bucket, (select count(*) from before where {_LEAF} = l.bucket) as rows_before,
               (select count(*) from after where {_LEAF} = l.bucket) as rows_after
        from leaves l""",
)
def fingerprint_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash buckets in which two versions differ, from their stored digest trees alone."""
    trees = []
    for rows in _versions(spark, sf_dir):
        path = fresh_dir(spark, "digest-tree")
        digests.write_tree(digests.digest_tree(rows, v.KEY), path)
        trees.append(digests.read_tree(spark, path))
    return digests.differing_buckets(*trees)


@query(
    "changed_rows",
    with_views("", "dirty").rstrip() + f""", {_BEFORE}, {_AFTER}
        select coalesce(b.flow_id, a.flow_id) as flow_id,
               case when b.flow_id is null then 'added' when a.flow_id is null then 'removed' else 'changed' end as change
        from before b full join after a on a.flow_id = b.flow_id
        where b.flow_id is null or a.flow_id is null or (b.user_id, b.value_txt, b.label) is distinct from (a.user_id, a.value_txt, a.label)""",
)
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the rows that differ between two versions; only rows of differing buckets are compared."""
    before, after = _versions(spark, sf_dir)
    buckets = fingerprint_diff(spark, sf_dir)
    return digests.changed_rows(before, after, buckets, v.KEY, COLUMNS)


@query("published_report", with_views('select label, count(*) as "count" from flows group by label', "flows"))
def published_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes of the newest finished run, between an older one and one that broke off."""
    out = fresh_dir(spark, "published")
    flows = v.flows(spark, sf_dir)
    for run, rows, ends in (("a", flows.where("label <> 'benign'"), True), ("b", flows, True), ("c", flows.limit(3), False)):
        write_reports({"label_counts": counting.label_counts(rows)}, f"{out}/{run}/reports")
        if ends:
            published.publish(spark, out, run)
    return published.read_published(spark, out, "label_counts")


# A run of the log for each member: its measures, settings and time by rule.
_RUN_METRICS = ("accuracy", "f1_score")


def _member_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log after one run for each member, appended run by run."""
    class_rows = v.classes(spark, sf_dir)
    scored = written(v.scored(spark, sf_dir, class_rows), "scored")
    path = fresh_dir(spark, "run-log")
    print_ = counting.fingerprint(scored, ["flow_id"])
    log = None
    for i, member in enumerate(v.members()):
        table = confusion.confusion_long(scored, predicted=member)
        metrics = confusion.rounded_metrics(confusion.global_metrics(table), 4).select(*_RUN_METRICS).first().asDict()
        params = {"member": i, "half": i // 2, "caps": v.CAPS["benign"]}
        steps = [("fit", 10.0 + i), ("score", 5.0 - i / 4)]
        log = runlog.record_run(spark, path, f"run-{i}", print_, metrics, params, steps=steps, finished=1_000_000 * (i + 1))
    return log


_LOG_RUNS = f"""
    scores as (
        select c.label, m.model, count(*) filter (where m.label_index = c.label_index and pred = c.label_index) as tp,
               count(*) filter (where m.label_index <> c.label_index and pred = c.label_index) as fp,
               count(*) filter (where m.label_index = c.label_index and pred <> c.label_index) as fn
        from classes c cross join members m group by all),
    measured as (
        select model, round(sum(tp)::double / sum(tp + fn), 4) as accuracy, round(sum({F1} * (tp + fn)) / sum(tp + fn), 4) as f1_score
        from scores group by model)"""


@query(
    "run_history",
    with_views("", "members").rstrip() + f""", {_LOG_RUNS}
        select 'run-' || model as run_id, (model + 1)::int as number, f1_score as metric,
               round(f1_score - lag(f1_score) over w, 4) as metric_change,
               row_number() over (order by f1_score desc, model) = 1 as best,
               case when model = 0 then '' when model % 2 = 1 then 'member: ' || (model - 1) || ' -> ' || model
                    else 'half: ' || (model // 2 - 1) || ' -> ' || model // 2 || '; member: ' || (model - 1) || ' -> ' || model end as changed_params,
               false as other_data, 15.0 + model * 0.75::double as seconds,
               case when model > 0 then 0.75::double end as seconds_change
        from measured window w as (order by model)""",
)
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a run of the log, in order of their ends: measure, best, and what differs from the run before."""
    return history.run_history(_member_log(spark, sf_dir), "f1_score")


@query(
    "run_steps",
    with_views("", "flows").rstrip() + f"""
        select 'run-' || i as run_id, step, case step when 'fit' then 10.0 + i else 5.0 - i / 4 end::double as seconds,
               case when i > 0 then case step when 'fit' then 1.0 else -0.25 end end::double as change
        from range({v.MEMBERS}) r(i) cross join (values ('fit'), ('score')) s(step)""",
)
def run_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds of each step of each run, and the change against the run before."""
    return history.step_changes(_member_log(spark, sf_dir))


@query(
    "run_metrics",
    with_views("", "members").rstrip() + f""", {_LOG_RUNS}
        select 'run-' || model as run_id, (model + 1)::int as number, accuracy, f1_score from measured""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log as one row a run with its measures as columns."""
    return history.runs_wide(_member_log(spark, sf_dir), _RUN_METRICS)
