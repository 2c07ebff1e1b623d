"""Samples, balancing, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators import cleaning, counting
from flowgauge.operators import sampling as ops
from flowgauge.plans.reports import top_importances
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import below, bucket, digest, with_views
from flowgauge.streaming.windows import event_time

_CAP = "case label " + " ".join(f"when '{c}' then {n}" for c, n in v.CAPS.items()) + " end"
_RANKED = f"""
    select flow_id, label, row_number() over (partition by label order by {digest(v.SEED)}, flow_id::varchar) as place,
           {_CAP} as cap
    from {{}} where label <> 'NULL'"""
_TEST = below(v.SEED, v.TEST_SHARE)


@query(
    "seeded_sample",
    with_views(
        f"select flow_id, label from ({_RANKED.format('flows')}) where label = 'benign' and place <= cap", "flows"
    ),
)
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.flows(spark, sf_dir).select("flow_id", "label")
    return ops.seeded_sample(rows, v.BENIGN, v.CAPS[v.BENIGN], v.KEY, v.SEED)


@query(
    "balance_classes",
    with_views(
        f"""select d.flow_id, d.label, d.value from dirty d
            join ({_RANKED.format('dirty')}) r using (flow_id) where cap is null or place <= cap""",
        "dirty",
    ),
)
def balance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.dirty(spark, sf_dir).select("flow_id", "label", "value")
    return ops.balance(rows, v.CAPS, v.KEY, v.SEED)


@query(
    "newest_per_class",
    with_views(
        f"""select flow_id, label from (
              select flow_id, label, row_number() over (partition by label order by epoch_us(ts) desc, flow_id::varchar) as place, {_CAP} as cap from flows)
            where cap is null or place <= cap""",
        "flows",
    ),
)
def newest_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest flows of the capped classes, and all flows of the others."""
    rows = v.flows(spark, sf_dir).select("flow_id", "label", (-F.unix_micros(event_time(F.col("ts")))).alias("age"))
    return ops.first_per_class(rows, v.CAPS, F.col("age"), v.KEY).select("flow_id", "label")


@query("union_all_classes", with_views("select flow_id, label from dirty where label <> 'NULL'", "dirty"))
def union_all_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.dirty(spark, sf_dir).select("flow_id", "label")
    capped = [cleaning.only_class(rows, c) for c in v.CAPS]
    return ops.union_all(*capped, cleaning.residual_classes(rows, v.CAPS))


@query(
    "split_train_test",
    with_views(f"select flow_id, case when {_TEST} then 'test' else 'train' end as part from flows", "flows"),
)
def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = ops.split(v.flows(spark, sf_dir).select("flow_id"), v.KEY, v.TEST_SHARE, v.SEED)
    return ops.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


@query(
    "fold_assign",
    with_views(f"select flow_id, {bucket(f'fold:{v.SEED}', v.FOLDS)}::int as fold from flows", "flows"),
)
def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_fold(v.flows(spark, sf_dir).select("flow_id"), v.KEY, v.FOLDS, v.SEED)


@query(
    "keep_ratio",
    with_views(
        f"""select sum(n)::bigint as raw_rows, sum(kept)::bigint as balanced_rows,
                   round(sum(kept)::double / sum(n) * 100.0, 1) as kept_percent
            from (select count(*) as n,
                         case when label <> 'NULL' then least(count(*), coalesce({_CAP}, count(*))) else 0 end as kept
                  from dirty group by label)""",
        "dirty",
    ),
)
def keep_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.keep_ratio(v.dirty(spark, sf_dir), v.CAPS)


@query(
    "split_ratio",
    with_views(
        f"""select count(*) filter (where not t) as train_rows, count(*) filter (where t) as test_rows,
                   round(count(*) filter (where not t)::double / count(*) * 100.0, 2) as train_percent,
                   round(count(*) filter (where t)::double / count(*) * 100.0, 2) as test_percent
            from (select {_TEST} as t from flows)""",
        "flows",
    ),
)
def split_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.split_ratio(v.flows(spark, sf_dir), v.KEY, v.TEST_SHARE, v.SEED)


@query(
    "top_features",
    with_views(
        f"select * from importances order by importance desc, feature limit {v.REPORT.top_features}", "importances"
    ),
)
def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_importances(v.importances(spark, sf_dir), v.REPORT.top_features)


_FINGERPRINT = ("flow_id", "user_id", "event_type", "label")


@query(
    "dataset_fingerprint",
    with_views(
        f"""select count(*) as "rows",
                   sum(('0x' || substr(md5({" || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in _FINGERPRINT)}),
                                       1, 8))::bigint)::varchar as digest
            from flows""",
        "flows",
    ),
)
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.fingerprint(v.flows(spark, sf_dir), _FINGERPRINT)
