"""Exact medians and percentiles of columns of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.attach import attach
from holdfast.operators.ranking import global_rank
from holdfast.session import settle, store

# The sketch places a value to within one row in this many.
ACCURACY = 10_000
# How far on either side of a share the sketch is asked for bounds.
MARGIN = 4 / ACCURACY
# Groups whose bounds are sent to all tasks, so that the rows of a group stay spread.
FEW_GROUPS = 10_000

def _between(low: Column, high: Column, target: Column) -> Column:
    """Linear between the values at the ranks around ``target``."""
    return low + (high - low) * (target - F.floor(target))


def percentiles_of_ranked(
    ranked: DataFrame,
    value: str,
    shares: Mapping[str, float],
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """One row (per group) with a column per named share, linear between neighbours.

    ``ranked`` carries a rank by ``value`` with nulls last; nulls do not count.
    ``total`` names a column with the number of values, which spares counting them.
    """
    groups = list(by)
    if total is None:
        total = "_n"
        values = F.count(value).alias(total)
        ranked = attach(ranked, ranked.groupBy(*groups).agg(values), groups)
    place = F.col(total) - F.col(rank) if descending else F.col(rank) - 1

    def at(share: float) -> Column:
        target = (F.col(total) - 1) * F.lit(share)
        below = F.max(F.when(place == F.floor(target), F.col(value)))
        above = F.max(F.when(place == F.ceil(target), F.col(value)))
        return _between(below, above, F.max(target))

    return ranked.groupBy(*groups).agg(*[at(share).alias(name) for name, share in shares.items()])


def percentiles_by_rank(
    df: DataFrame, value: str, shares: Mapping[str, float], key: str, by: Sequence[str] = ()
) -> DataFrame:
    """Percentiles from a global rank of all values: one range shuffle, no sketch."""
    groups = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"), F.col(key).alias("_k"))
    ranked = global_rank(rows, [F.col("_v").asc(), F.col("_k").asc()], by=groups, rank="_rank", total="_total")
    return percentiles_of_ranked(ranked, "_v", shares, groups, rank="_rank", total="_total")


def percentiles(
    df: DataFrame, value: str, shares: Mapping[str, float], key: str, by: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles, one row (per group) with a column per named share.

    One way for groups of every size: no task ever holds a group's values. Eager:
    the narrow input is stored once, then read for the sketch and the counts.
    """
    groups = list(by)
    narrow = store(df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"), F.col(key).alias("_k")))
    return _bracketed_percentiles(narrow, settle(_brackets(narrow, shares, groups)), shares, groups)


def _brackets(narrow: DataFrame, shares: Mapping[str, float], groups: list[str]) -> DataFrame:
    """Per group its size and, per share, two values with the target from one to the other."""
    ends = [min(1.0, max(0.0, share + side)) for share in shares.values() for side in (-MARGIN, MARGIN)]
    sketch = narrow.groupBy(*groups).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", ends, ACCURACY).alias("_ends"),
    )
    return sketch.select(
        *groups, "_n",
        *[F.col("_ends")[2 * i].alias(f"_lo{i}") for i in range(len(shares))],
        *[F.col("_ends")[2 * i + 1].alias(f"_hi{i}") for i in range(len(shares))],
    )


def _attached(rows: DataFrame, facts: DataFrame, groups: list[str]) -> DataFrame:
    """Rows with their group's settled facts. Only where groups are many are rows shuffled by group."""
    few = facts.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    return attach(rows, F.broadcast(facts) if few else facts, groups)


def _bracketed_percentiles(
    narrow: DataFrame, brackets: DataFrame, shares: Mapping[str, float], groups: list[str]
) -> DataFrame:
    """Percentiles of ``_v`` without sorting all of it.

    A sketch brackets each target between two values of the data. Rows below, at
    and between the two are counted. Mostly the target is one of the two; if it
    is not, only the rows strictly between them, some ten-thousandths of the
    data, are ranked. No value that many rows share can lie strictly between, so
    ties cost nothing. Should the counts show that the sketch missed a target,
    all rows are ranked instead.
    """
    names, values = list(shares), F.col("_v")
    bracketed = _attached(narrow, brackets, groups)

    def inside(i: int) -> Column:
        return (values > F.col(f"_lo{i}")) & (values < F.col(f"_hi{i}"))

    measures = [F.max("_n").alias("_n")]
    for i in range(len(names)):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        measures += [
            F.max(low).alias(f"_lo{i}"), F.max(high).alias(f"_hi{i}"),
            F.count_if(values < low).alias(f"_under{i}"), F.count_if(values <= low).alias(f"_from{i}"),
            F.count_if(values < high).alias(f"_to{i}"), F.count_if(values <= high).alias(f"_upto{i}"),
        ]
    counts = settle(bracketed.groupBy(*groups).agg(*measures)).where(F.col("_n") > 0)

    # (share, side) to the place counted from zero; places from _from to _to are strictly between.
    targets = {i: (F.col("_n") - 1) * F.lit(share) for i, share in enumerate(shares.values())}
    places = {(i, side): near(target) for i, target in targets.items() for side, near in ((0, F.floor), (1, F.ceil))}

    def is_open(i: int, side: int) -> Column:
        return (places[i, side] >= F.col(f"_from{i}")) & (places[i, side] < F.col(f"_to{i}"))

    missed = [(place < F.col(f"_under{i}")) | (place >= F.col(f"_upto{i}")) for (i, _), place in places.items()]
    if not counts.where(reduce(or_, missed)).isEmpty():
        return percentiles_by_rank(narrow, "_v", shares, "_k", groups)

    open_somewhere = reduce(or_, [is_open(*spot) for spot in places])
    if counts.where(open_somewhere).isEmpty():
        found = counts.select("*", *[F.lit(None).cast("double").alias(f"_pick{i}_{side}") for i, side in places])
    else:
        hits = [inside(i) & (is_open(i, 0) | is_open(i, 1)) for i in targets]
        located = _attached(narrow, counts, groups).where(reduce(or_, hits))
        hit_shares = F.array_compact(F.array(*[F.when(hit, F.lit(i)) for i, hit in enumerate(hits)]))
        strict = store(located.select(*groups, "_v", "_k", F.explode(hit_shares).alias("_share")))
        ranked = global_rank(
            strict, [F.col("_v").asc(), F.col("_k").asc()], by=[*groups, "_share"], rank="_rank", total="_total"
        )
        picks = _attached(ranked, counts, groups).groupBy(*groups).agg(
            *[
                F.max(
                    F.when((F.col("_share") == i) & (F.col("_rank") == place - F.col(f"_from{i}") + 1), values)
                ).alias(f"_pick{i}_{side}")
                for (i, side), place in places.items()
            ]
        )
        found = attach(counts, picks, groups, how="left")

    def at(i: int, side: int) -> Column:
        place = places[i, side]
        return (
            F.when(place < F.col(f"_from{i}"), F.col(f"_lo{i}"))
            .when(place >= F.col(f"_to{i}"), F.col(f"_hi{i}"))
            .otherwise(F.col(f"_pick{i}_{side}"))
        )

    return found.select(*groups, *[_between(at(i, 0), at(i, 1), targets[i]).alias(name) for i, name in enumerate(names)])


def median(df: DataFrame, value: str, key: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return percentiles(df, value, {name: 0.5}, key, by)


def approximate_percentiles(
    df: DataFrame, value: str, shares: Mapping[str, float], by: Sequence[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """The sketch alone; rank error up to rows / accuracy."""
    return df.groupBy(*by).agg(*[F.percentile_approx(value, share, accuracy).alias(name) for name, share in shares.items()])


#: Size of a stored sketch, and the share of rows by which a value's place may be off its share, with 99% confidence.
SKETCH_SIZE, SKETCH_ERROR = 2_000, 0.005


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """(by, sketch): a mergeable KLL sketch of each group's values, some kilobytes whatever its rows; nulls do not count.

    Sketches can be stored and appended to: those of new rows are merged with the
    old ones, which are not read again.
    """
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of finer groups, or of parts of the rows, as one for each group of ``by``."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))


def sketched_percentiles(sketches: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """The sketches' other columns, with a column per named share: a value within ``SKETCH_ERROR`` of its place; null for no values."""
    some = F.kll_sketch_get_n_double("sketch") > 0
    found = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share)))).alias(name) for name, share in shares.items()]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *found)
