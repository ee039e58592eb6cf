"""Small numeric expressions that other modules share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """``value`` held inside [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, null where the bottom is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent_of(flag: Column) -> Column:
    """Share of rows where ``flag`` holds, in percent (an aggregate)."""
    return F.avg(flag.cast("int")) * 100


def mean_where(condition: Column, value: Column) -> Column:
    """Mean of ``value`` over rows where ``condition`` holds; null if there are none."""
    return F.avg(F.when(condition, value))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over rows where ``condition`` holds; zero if there are none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def lenient_number(text: Column) -> Column:
    """Text as double; what is not a number becomes null instead of an error."""
    return text.try_cast("double")


def yes_flag(text: Column) -> Column:
    """1 for ``Yes``, 0 for anything else, null included."""
    return F.when(text == "Yes", 1).otherwise(0)


def fixed(value: Column, digits: int) -> Column:
    """Round half away from zero, as double, once: the shortest decimal that stands for the value is rounded.

    NaN, infinities and values of any size keep their meaning; only null gives null.
    """
    return F.round(value.cast("double"), digits)
