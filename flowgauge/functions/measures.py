"""Ratios that are zero on an empty denominator, and label bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0.0 where whole is zero or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(share: Column, digits: int = 2) -> Column:
    return F.round(share * 100.0, digits)


def band(value: Column, bands: Sequence[tuple[str, float]], rest: str, inclusive: bool) -> Column:
    """Name of the first band whose lower bound the value passes."""
    out = F.lit(rest)
    for name, bound in reversed(bands):
        out = F.when(value >= bound if inclusive else value > bound, name).otherwise(out)
    return out


def grouped(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number.cast("bigint"), 0)


def two_decimals(number: Column) -> Column:
    return F.format_string("%.2f", number.cast("double"))


def finite(column: Column) -> Column:
    """The value, or null where it is infinite."""
    return F.when(~column.isin(float("inf"), float("-inf")), column)
