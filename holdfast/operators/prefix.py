"""Cumulative counts at evenly spaced ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

POINTS = 100


def stride(total: Column) -> Column:
    """Ranks between two points: a hundredth of the rows, at least one."""
    return F.greatest(F.lit(1), F.floor(total / POINTS))


def step_of(rank: Column, total: Column, start: int) -> Column:
    """The first point at or after a rank: step j is the point at rank start + j * stride.

    There are at most 200 steps. Ranks past the last point get one more step.
    """
    return F.greatest(F.lit(0), F.ceil((rank - start) / stride(total)))


def accumulate(
    steps: DataFrame, start: int, names: Sequence[str], by: Sequence[str] = (), step: str = "step", total: str = "n_rows"
) -> DataFrame:
    """Sums per step to sums over ranks 1..k at every point k, and ``all_<name>`` over every row."""
    whole = W.partitionBy(*by, total)
    upto = whole.orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    return steps.select(
        *by, total, (F.lit(start) + F.col(step) * stride(F.col(total))).alias("k"),
        *[F.sum(name).over(upto).alias(name) for name in names],
        *[F.sum(name).over(whole).alias(f"all_{name}") for name in names],
    ).where(F.col("k") <= F.col(total))


def prefix_sums(
    ranked: DataFrame,
    start: int,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str = "n_rows",
) -> DataFrame:
    """Sums over ranks 1..k at k = start, start + stride, ... while k stays within the rows.

    Rows are summed per step before any shuffle, and only steps are accumulated.
    Integer summands stay exact.
    """
    step = step_of(F.col(rank), F.col(total), start).alias("step")
    steps = ranked.groupBy(*by, total, step).agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    return accumulate(steps, start, list(sums), by, total=total)
