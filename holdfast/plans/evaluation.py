"""How well a score ranks customers by the effect of the offer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.numeric import fixed, percent_of, ratio
from holdfast.operators.attach import attach
from holdfast.operators.cuts import refine
from holdfast.operators.prefix import POINTS, accumulate, step_of
from holdfast.operators.quantiles import percentiles_of_ranked
from holdfast.operators.ranking import global_rank
from holdfast.session import settle, store

TOP_PERCENTS = (10, 20, 30, 40, 50)
GAIN_START = 100
AGREEMENT = 0.7
QINI_TOLERANCE = 0.001
# Wording of the agreement.
AGREE, DISAGREE = "High agreement", "Methods disagree significantly"


_SUMS = ["n_t", "n_c", "y_t", "y_c"]


@dataclass(frozen=True)
class ScoreCuts:
    """What the metrics below need of scores: arm counts between ranks, and the spread of the scores."""

    steps: DataFrame
    spread: DataFrame


def _ranks_of_interest(n: int, percents: Sequence[int]) -> list[int]:
    """The last rank of every stretch that no point of a curve and no top share divides."""
    stride = max(1, n // POINTS)
    return [*range(1, n + 1, stride), *range(GAIN_START, n + 1, stride), *[n * k // 100 for k in percents], n]


def cut_scores(
    df: DataFrame, scores: Mapping[str, str], key: str = "customer_id", outcome: str = "churn_binary",
    treatment: str = "treatment", percents: Sequence[int] = TOP_PERCENTS,
) -> ScoreCuts:
    """Arm counts and churn between all ranks that any metric below looks at, and each learner's spread.

    ``scores`` maps a learner's name to its score column. Best score first; ties are
    ordered by the key and customers without a score come last. The ranks are cut
    exactly by refined histograms (``operators.cuts``): no row is ranked or
    shuffled. Some two hundred rows per learner remain, whatever the number of
    customers. Eager: stores the narrow columns once and reads them a few times.
    """
    names = list(scores)
    narrow = store(df.select(F.col(key).alias("_key"), F.col(outcome).cast("long").alias("y"), F.col(treatment).cast("long").alias("t"), *[F.col(c).alias(f"score_{i}") for i, c in enumerate(scores.values())]))
    one_each = F.inline(F.array(*[F.struct(F.lit(i).alias("learner"), F.col(f"score_{i}").alias("score")) for i in range(len(names))]))
    rows = narrow.select("_key", "y", "t", one_each)
    t, y = F.col("t"), F.col("y")
    sums = {"n_t": t, "n_c": 1 - t, "y_t": t * y, "y_c": (1 - t) * y}
    found = refine(
        rows, "score", "_key", lambda n: _ranks_of_interest(n, percents), sums, group=F.col("learner"), labels=names,
        places=lambda n, scored: [(scored - 1) // 2 + 1, scored // 2 + 1],
    )
    steps, middles = [], []
    for name in names:
        before, added = 0, dict.fromkeys(sums, 0)
        for cut in found.cuts[name]:
            own = {k: cut.sums[k] - added[k] for k in sums}
            top = min((k for k in percents if cut.rank <= cut.total * k // 100), default=None)
            steps.append((name, cut.total, cut.rank, top, *own.values()))
            before, added = cut.rank, cut.sums
        pair = [v for _, v in sorted(found.values[name].items()) if v is not None]  # the higher one first
        middles.append((name, pair[-1] + (pair[0] - pair[-1]) * 0.5 if pair else None))
    spark = df.sparkSession
    table = spark.createDataFrame(steps, "learner string, n_rows long, rank long, top int, n_t long, n_c long, y_t long, y_c long")
    n = F.col("n_rows")
    table = table.select("learner", "n_rows", step_of(F.col("rank"), n, 1).alias("qini_step"), step_of(F.col("rank"), n, GAIN_START).alias("gain_step"), "top", *_SUMS)
    score = lambda i: F.col(f"score_{i}")
    spread = narrow.agg(*[F.struct(*[x.alias(k) for k, x in _spread(score(i)).items()]).alias(f"s{i}") for i in range(len(names))])
    one_row = F.inline(F.array(*[F.struct(F.lit(name).alias("learner"), *[F.col(f"s{i}.{k}").alias(k) for k in _spread(score(i))]) for i, name in enumerate(names)]))
    return ScoreCuts(table, spread.select(one_row).join(spark.createDataFrame(middles, "learner string, median double"), "learner", "left"))


def ranked_scores(
    df: DataFrame, scores: Mapping[str, str], key: str = "customer_id",
    outcome: str = "churn_binary", treatment: str = "treatment",
) -> DataFrame:
    """One row per learner and customer with its rank, best score first; where ``cut_scores`` is not enough.

    ``scores`` maps a learner's name to its score column. All learners share one
    range shuffle of five narrow columns. Ties are ordered by the key and
    customers without a score come last.
    """
    one_each = F.inline(
        F.array(*[F.struct(F.lit(name).alias("learner"), F.col(column).alias("score")) for name, column in scores.items()])
    )
    rows = df.select(F.col(key).alias("_key"), F.col(outcome).alias("y"), F.col(treatment).alias("t"), one_each)
    return global_rank(rows, [F.col("score").desc_nulls_last(), F.col("_key").asc()], by=["learner"])


def rank_steps(ranked: DataFrame, percents: Sequence[int] = TOP_PERCENTS) -> DataFrame:
    """Arm counts and churn between all ranks that any metric below looks at.

    One pass over the ranks serves every curve. A row per learner and stretch of
    ranks remains, a few hundred per learner whatever the number of customers.
    """
    t, y, n = F.col("t").cast("long"), F.col("y").cast("long"), F.col("n_rows")
    top = F.lit(None).cast("int")
    for k in sorted(percents, reverse=True):
        top = F.when(F.col("rank") <= F.floor(n * k / 100), k).otherwise(top)
    return ranked.groupBy(
        "learner", "n_rows",
        step_of(F.col("rank"), n, 1).alias("qini_step"),
        step_of(F.col("rank"), n, GAIN_START).alias("gain_step"),
        top.alias("top"),
    ).agg(
        F.sum(t).alias("n_t"), F.sum(1 - t).alias("n_c"), F.sum(t * y).alias("y_t"), F.sum((1 - t) * y).alias("y_c")
    )


def _spread(score: Column) -> dict[str, Column]:
    return {
        "mean_uplift": fixed(F.avg(score), 4),
        "std_uplift": fixed(F.stddev_pop(score), 4),
        "pct_positive_uplift": fixed(percent_of(score > 0), 1),
    }


def _points(steps: DataFrame, step: str, start: int) -> DataFrame:
    """Cumulative counts at the points of one curve where both arms have rows."""
    per_step = steps.groupBy("learner", "n_rows", step).agg(*[F.sum(name).alias(name) for name in _SUMS])
    points = accumulate(per_step, start, _SUMS, ["learner"], step)
    return points.where((F.col("n_t") > 0) & (F.col("n_c") > 0))


def _effect(prefix: str = "") -> Column:
    """Control churn minus treated churn; null while an arm is empty."""
    return ratio(F.col(f"{prefix}y_c"), F.col(f"{prefix}n_c")) - ratio(F.col(f"{prefix}y_t"), F.col(f"{prefix}n_t"))


def qini_curve(steps: DataFrame) -> DataFrame:
    """(learner, k, fraction, qini, random_qini): about a hundred points per learner."""
    fraction = F.col("k") / F.col("n_rows")
    return _points(steps, "qini_step", 1).select(
        "learner", "k", fraction.alias("fraction"),
        (_effect() * fraction).alias("qini"),
        (fraction * _effect("all_")).alias("random_qini"),
    )


def qini_coefficients(curve: DataFrame) -> DataFrame:
    """Trapezoid area between curve and random line, per learner."""
    w = W.partitionBy("learner").orderBy("k")
    gain = F.col("qini") - F.col("random_qini")
    pieces = curve.select(
        "learner",
        ((gain + F.lag(gain).over(w)) / 2 * (F.col("fraction") - F.lag("fraction").over(w))).alias("_area"),
    )
    return pieces.groupBy("learner").agg(F.coalesce(F.sum("_area"), F.lit(0.0)).alias("qini_coefficient"))


def cumulative_gain(steps: DataFrame) -> DataFrame:
    """(learner, k, fraction, gain) from the first hundred customers on."""
    return _points(steps, "gain_step", GAIN_START).select(
        "learner", "k", (F.col("k") / F.col("n_rows")).alias("fraction"), _effect().alias("gain")
    )


def uplift_at_k(steps: DataFrame, percents: Sequence[int] = TOP_PERCENTS) -> DataFrame:
    """Effect among the top k percent per learner, and the share of the total it captures.

    Zeros where an arm is empty or the total effect is zero. ``percents`` are
    some of those the steps were made with.
    """
    cutoffs = F.explode(F.array(*[F.lit(k) for k in percents])).alias("k_pct")
    inside = F.col("top") <= F.col("k_pct")
    sums = steps.select("learner", "n_rows", "top", *_SUMS, cutoffs).groupBy("learner", "n_rows", "k_pct").agg(
        *[F.sum(name).alias(f"all_{name}") for name in _SUMS],
        *[F.coalesce(F.sum(F.when(inside, F.col(name))), F.lit(0)).alias(name) for name in _SUMS],
    )
    share = F.col("k_pct") / 100
    found = sums.select(
        "learner", "k_pct", _effect("all_").alias("_all"),
        F.when(_effect("all_") != 0, F.coalesce(_effect(), F.lit(0.0))).otherwise(0.0).alias("effect"),
        F.floor(F.col("n_rows") * F.col("k_pct") / 100).alias("n_targeted"),
        F.col("n_t").alias("n_treated"), F.col("n_c").alias("n_control"),
    )
    captured = F.coalesce(ratio(F.col("effect"), F.col("_all")) * share * 100, F.lit(0.0)).alias("capture_pct")
    return found.select("learner", "k_pct", "effect", captured, "n_targeted", "n_treated", "n_control")


def _metrics(steps: DataFrame, percents: Sequence[int]) -> DataFrame:
    """One row per learner: Qini coefficient, effects at k, first and last gain."""
    steps = settle(steps)
    effects = uplift_at_k(steps, percents).groupBy("learner").agg(
        *[F.max(F.when(F.col("k_pct") == k, F.col("effect"))).alias(f"effect_{k}") for k in percents]
    )
    gains = cumulative_gain(steps).groupBy("learner").agg(
        F.min_by("gain", "k").alias("first_gain"), F.max_by("gain", "k").alias("last_gain"), F.count("*").alias("_points")
    ).where(F.col("_points") > 1)
    joined = effects.join(qini_coefficients(qini_curve(steps)), "learner", "left").join(gains, "learner", "left")
    return joined.withColumn("qini", F.coalesce("qini_coefficient", F.lit(0.0)))


def _ranked_spread(ranked: DataFrame) -> DataFrame:
    counted = ranked.groupBy("learner").agg(F.count("score").alias("_scored"), *[x.alias(k) for k, x in _spread(F.col("score")).items()])
    rows = attach(ranked, counted.select("learner", "_scored"), "learner")
    middle = percentiles_of_ranked(rows, "score", {"median": 0.5}, by=["learner"], total="_scored", descending=True)
    return counted.drop("_scored").join(middle, "learner")


def learner_report(source: ScoreCuts | DataFrame) -> DataFrame:
    """One row per learner: ranking quality and the spread of its scores; from cuts, or from ranked rows."""
    cuts = source if isinstance(source, ScoreCuts) else ScoreCuts(rank_steps(source), _ranked_spread(source))
    return _metrics(cuts.steps, (10, 20, 50)).join(F.broadcast(cuts.spread), "learner").select(
        F.col("learner").alias("model"),
        fixed(F.col("qini"), 6).alias("qini_coefficient"),
        "mean_uplift", fixed(F.col("median"), 4).alias("median_uplift"), "std_uplift", "pct_positive_uplift",
        *[fixed(F.col(f"effect_{k}"), 4).alias(f"uplift_at_{k}") for k in (10, 20, 50)],
    )


def _agreement(r: Column) -> Column:
    return F.when(r > AGREEMENT, AGREE).otherwise(DISAGREE)


def score_correlation(df: DataFrame, first: str, second: str) -> DataFrame:
    """Pearson correlation of two scores; rows missing either do not count."""
    r = F.corr(first, second)
    return df.agg(fixed(r, 4).alias("correlation"), _agreement(r).alias("agreement"))


def compare_learners(
    df: DataFrame, first: tuple[str, str], second: tuple[str, str], cuts: ScoreCuts | None = None
) -> DataFrame:
    """One row: Qini, uplift@k and gains of two learners side by side, and a verdict.

    ``first`` and ``second`` are (name, score column); a tie in Qini goes to the second.
    """
    cuts = cut_scores(df, dict([first, second])) if cuts is None else cuts
    metrics = _metrics(cuts.steps, TOP_PERCENTS)
    wanted = ["qini", *[f"effect_{k}" for k in TOP_PERCENTS], "first_gain", "last_gain"]
    sides = {"first": first[0], "second": second[0]}
    picked = metrics.agg(
        *[
            F.max(F.when(F.col("learner") == learner, F.col(name))).alias(f"{name}_{side}")
            for side, learner in sides.items()
            for name in wanted
        ]
    )
    better = F.when(F.col("qini_first") > F.col("qini_second"), first[0]).otherwise(second[0])
    close = F.abs(F.col("qini_first") - F.col("qini_second")) < QINI_TOLERANCE
    r = df.agg(F.corr(first[1], second[1]).alias("r")).scalar()
    return picked.withColumn("_r", r).select(
        *[fixed(F.col(name), 6).alias(name) for name in picked.columns],
        fixed(F.col("_r"), 4).alias("correlation"),
        _agreement(F.col("_r")).alias("agreement"),
        better.alias("winner"),
        F.when(close, F.lit(first[0])).otherwise(better).alias("recommended"),
    )
