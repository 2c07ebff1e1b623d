"""Filters, projections and the cleaning chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowgauge.operators import cleaning as ops
from flowgauge.operators.counting import null_counts
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import with_views

_CAPPED = ", ".join(f"'{c}'" for c in v.CAPS)
_KEPT = ("benign", "scan", "botnet")


@query("drop_null_label", with_views("select flow_id, label from dirty where label <> 'NULL'", "dirty"))
def drop_null_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.labelled(v.dirty(spark, sf_dir)).select("flow_id", "label")


@query("class_filter", with_views(f"select flow_id, label, value from flows where label = '{v.CHOICE}'", "flows"))
def class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.only_class(v.flows(spark, sf_dir), v.CHOICE).select("flow_id", "label", "value")


@query(
    "residual_classes",
    with_views(f"select flow_id, label from dirty where label not in ({_CAPPED}) and label <> 'NULL'", "dirty"),
)
def residual_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.residual_classes(v.dirty(spark, sf_dir), v.CAPS).select("flow_id", "label")


@query(
    "label_whitelist",
    with_views(f"select flow_id, label from dirty where label in ({', '.join(repr(x) for x in _KEPT)})", "dirty"),
)
def label_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.keep_labels(v.dirty(spark, sf_dir), _KEPT).select("flow_id", "label")


@query("feature_drop", with_views("select flow_id, user_id, value, value_txt, k, label from dirty", "dirty"))
def feature_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_columns(v.dirty(spark, sf_dir), v.CLEAN, keep=(v.KEY,))


@query(
    "try_cast_double", with_views("select flow_id, try_cast(value_txt as double) as value_txt from dirty", "dirty")
)
def try_cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.cast_to_double(v.dirty(spark, sf_dir), v.CLEAN.cast_columns).select("flow_id", "value_txt")


@query(
    "inf_to_null",
    with_views(
        """select flow_id, case when not isinf(x) then x end as value_txt, value
           from (select flow_id, try_cast(value_txt as double) as x, value from dirty)""",
        "dirty",
    ),
)
def inf_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = ops.cast_to_double(v.dirty(spark, sf_dir), v.CLEAN.cast_columns)
    return ops.infinite_to_null(cast).select("flow_id", "value_txt", "value")


@query(
    "drop_incomplete",
    with_views(
        """select * from (select flow_id, label, try_cast(value_txt as double) as value_txt from dirty)
           where label is not null and value_txt is not null and not isnan(value_txt)""",
        "dirty",
    ),
)
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = ops.cast_to_double(v.dirty(spark, sf_dir), v.CLEAN.cast_columns)
    return ops.drop_incomplete(cast.select("flow_id", "label", "value_txt"))


@query(
    "clean_flows",
    with_views(
        """select flow_id, user_id, value, x as value_txt, k, label
           from (select *, try_cast(value_txt as double) as x from dirty)
           where label <> 'NULL' and x is not null and isfinite(x) and isfinite(value) and isfinite(k)
             and user_id is not null""",
        "dirty",
    ),
)
def clean_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean(ops.labelled(v.dirty(spark, sf_dir)), v.CLEAN, keep=(v.KEY,))


_COLUMN = """select '{0}' as "column", count(*) filter (where {1} is null) as nulls, {2} as nans, {3} as infinities
             from cast_rows"""


def _null_sql() -> str:
    parts = []
    for name, real in (("flow_id", False), ("value_txt", True), ("value", True), ("k", True), ("label", False)):
        column = f'"{name}"'
        nans = f"count(*) filter (where isnan({column}))" if real else "0::bigint"
        infinities = f"count(*) filter (where isinf({column}))" if real else "0::bigint"
        parts.append(_COLUMN.format(name, column, nans, infinities))
    rows = "(select flow_id, try_cast(value_txt as double) as value_txt, value, k, label from dirty)"
    return " union all ".join(parts).replace("cast_rows", rows)


@query("null_counts", with_views(_null_sql(), "dirty"))
def null_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = ops.cast_to_double(v.dirty(spark, sf_dir), v.CLEAN.cast_columns)
    return null_counts(cast.select("flow_id", "value_txt", "value", "k", "label"))
