"""Filters, projections and the cleaning chain; every step is narrow."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions.measures import finite
from flowgauge.params import NULL_LABEL, CleanParams


def labelled(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows with a class: neither null nor the text NULL."""
    return df.filter(F.col(label) != NULL_LABEL)


def only_class(df: DataFrame, name: str, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) == name)


def is_residual(capped: Iterable[str], label: str = "label") -> Column:
    """True for rows of a class that is neither capped nor the null marker."""
    return ~F.col(label).isin(*capped, NULL_LABEL)


def residual_classes(df: DataFrame, capped: Iterable[str], label: str = "label") -> DataFrame:
    return df.filter(is_residual(capped, label))


def keep_labels(df: DataFrame, labels: Sequence[str], label: str = "label") -> DataFrame:
    return df.filter(F.col(label).isin(*labels))


def drop_columns(df: DataFrame, params: CleanParams, keep: Sequence[str] = ()) -> DataFrame:
    """Without the listed columns and the text protocol; absent names are ignored.

    `keep` holds back columns, such as the row key that later draws need.
    """
    kept = {k.lower() for k in keep}
    gone = [c for c in (*params.drop_columns, params.text_protocol) if c.lower() not in kept]
    return df.drop(*gone)


def cast_to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns as doubles, in one projection; bad text becomes null."""
    wanted = {c.lower() for c in columns}
    return df.select(
        *[
            F.col(f"`{c}`").try_cast("double").alias(c) if c.lower() in wanted else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def infinite_to_null(df: DataFrame) -> DataFrame:
    """Infinities of every double column become null, in one projection."""
    return df.select(
        *[
            finite(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Without the rows that hold a null or NaN anywhere."""
    return df.na.drop("any")


def clean(df: DataFrame, params: CleanParams, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns, cast, null the infinities, drop incomplete rows.

    A row with an infinity is dropped once that is null, so one filter on finite
    values does both steps and parses each text once less.
    """
    cast = cast_to_double(drop_columns(df, params, keep), params.cast_columns)
    return cast.filter(reduce(and_, [_is_complete(f) for f in cast.schema.fields]))


def _is_complete(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    real = isinstance(field.dataType, (T.DoubleType, T.FloatType))
    # NaN sorts above infinity, so one comparison leaves out both and null.
    return F.abs(value) < float("inf") if real else value.isNotNull()


def feature_columns(df: DataFrame, *others: str) -> list[str]:
    """Every column but the label, its index and the others named."""
    skip = {"label", "label_index", "features", *[o.lower() for o in others]}
    return [c for c in df.columns if c.lower() not in skip]
