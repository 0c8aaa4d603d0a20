"""Casts, ratios and comparisons."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole(df: DataFrame, name: str) -> Column:
    """Strict cast to bigint; fractions round half away from zero, bad text raises."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        col = F.round(col)
    return col.cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is zero or NULL."""
    return F.try_divide(numerator, denominator)


def percent(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * 100


def for_year(year: Column, years: Iterable[int], column_of: str) -> Column:
    """Value of the column that belongs to `year` (`column_of` holds `{year}`); else NULL."""
    return F.coalesce(*[F.when(year == y, F.col(column_of.format(year=y))) for y in years])


def deviation(actual: Column, target: Column) -> Column:
    return actual - target


def target_met(actual: Column, target: Column) -> Column:
    """TRUE, FALSE, or NULL when either side is missing."""
    return actual >= target
