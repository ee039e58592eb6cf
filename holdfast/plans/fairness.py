"""Do segments and scores treat demographic groups alike?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.customer import senior_label
from holdfast.functions.numeric import fixed, ratio, sum_where
from holdfast.operators.quantiles import median
from holdfast.schemas import QUADRANTS

# Limits of the parity and effect-size checks.
PARITY_RATIO, PARITY_POINTS = 0.80, 10
SMALL_EFFECT, MEDIUM_EFFECT = 0.20, 0.50
SHARE_POINTS = 5


def demographics() -> dict[str, Column]:
    """Demographic name to the column with its groups."""
    return {"gender": F.col("gender"), "senior_label": senior_label(F.col("senior_citizen")), "partner": F.col("partner")}


def _memberships() -> Column:
    return F.inline(
        F.array(
            *[F.struct(F.lit(name).alias("demographic"), group.alias("group")) for name, group in demographics().items()]
        )
    )


def _count_name(quadrant: str) -> str:
    return "n_" + quadrant.lower().replace(" ", "_")


def _rate_name(quadrant: str) -> str:
    return "pct_" + quadrant.lower().replace(" ", "_")


def _rate(quadrant: str) -> Column:
    return ratio(F.col(_count_name(quadrant)), F.col("n_customers")) * 100


def group_totals(segmented: DataFrame) -> DataFrame:
    """Counts and sums per (demographic, group); every report below projects from these.

    Rows are summed once per combination of demographics, so each row is read
    once and only the few combinations are spread over the demographics.
    """
    chosen = F.col("quadrant") == "Persuadable"
    measures = {
        "n_customers": F.count("*"),
        **{_count_name(q): F.count_if(F.col("quadrant") == q) for q in QUADRANTS},
        "n_scored": F.count("uplift_score"),
        "uplift": F.sum("uplift_score"),
        "clv": F.sum("clv"),
        "value": F.sum("value_at_risk"),
        "chosen_uplift": sum_where(chosen, F.col("uplift_score")),
        "chosen_clv": sum_where(chosen, F.col("clv")),
        "chosen_value": sum_where(chosen, F.col("value_at_risk")),
    }
    combined = segmented.groupBy("gender", "senior_citizen", "partner").agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    return (
        combined.select(*measures, _memberships())
        .where(F.col("group").isNotNull())
        .groupBy("demographic", "group")
        .agg(*[F.sum(name).alias(name) for name in measures])
    )


def _mean(total: str, count: str) -> Column:
    return ratio(F.col(total), F.col(count))


def quadrant_rates_report(segmented: DataFrame) -> DataFrame:
    """Share of each quadrant, mean uplift and mean value per group."""
    return group_totals(segmented).select(
        "demographic", "group", "n_customers",
        *[fixed(_rate(q), 1).alias(_rate_name(q)) for q in QUADRANTS],
        fixed(_mean("uplift", "n_scored"), 4).alias("avg_uplift"),
        fixed(_mean("clv", "n_customers"), 0).alias("avg_clv"),
    )


def parity_check(segmented: DataFrame) -> DataFrame:
    """Highest against lowest Persuadable rate per demographic with at least two groups."""
    rate = _rate("Persuadable")
    spread = group_totals(segmented).groupBy("demographic").agg(
        F.count("*").alias("n_groups"), F.max(rate).alias("max_rate"), F.min(rate).alias("min_rate")
    )
    difference = F.col("max_rate") - F.col("min_rate")
    share = ratio(F.col("min_rate"), F.col("max_rate"))
    passed = (share >= PARITY_RATIO) & (difference < PARITY_POINTS)
    return spread.where((F.col("n_groups") >= 2) & (F.col("max_rate") > 0)).select(
        "demographic",
        fixed(F.col("max_rate"), 1).alias("max_rate"),
        fixed(F.col("min_rate"), 1).alias("min_rate"),
        fixed(difference, 1).alias("difference_pp"),
        fixed(share, 3).alias("parity_ratio"),
        F.when(passed, "PASS").otherwise("FLAG").alias("verdict"),
    )


def uplift_by_group(segmented: DataFrame, key: str = "customer_id") -> DataFrame:
    """Mean, median, sample spread and count of the score per group."""
    rows = segmented.select(key, "uplift_score", _memberships()).where(F.col("group").isNotNull())
    groups = ["demographic", "group"]
    basic = rows.groupBy(*groups).agg(
        fixed(F.avg("uplift_score"), 6).alias("mean_uplift"),
        fixed(F.stddev_samp("uplift_score"), 6).alias("std_uplift"),
        F.count("uplift_score").alias("n_scored"),
    )
    middle = median(rows, "uplift_score", key, by=groups, name="_median")
    return basic.join(middle, groups, "left").select(
        *groups, "mean_uplift", fixed(F.col("_median"), 6).alias("median_uplift"), "std_uplift", "n_scored"
    )


def uplift_gap(segmented: DataFrame) -> DataFrame:
    """Largest gap between group means per demographic, as an effect size."""
    mean = _mean("uplift", "n_scored")
    spread = segmented.agg(F.stddev_samp("uplift_score").alias("_std")).scalar()
    gaps = group_totals(segmented).groupBy("demographic").agg(
        F.count("*").alias("n_groups"), (F.max(mean) - F.min(mean)).alias("_gap")
    ).where(F.col("n_groups") >= 2).withColumn("_std", spread)
    effect = F.when(F.col("_std") > 0, F.col("_gap") / F.col("_std")).otherwise(0.0)
    band = F.when(effect < SMALL_EFFECT, "negligible").when(effect < MEDIUM_EFFECT, "small").otherwise("medium or large")
    return gaps.select(
        "demographic", fixed(F.col("_gap"), 6).alias("max_difference"), fixed(effect, 6).alias("effect_size"), band.alias("band")
    )


def persuadable_value(segmented: DataFrame) -> DataFrame:
    """Who the Persuadables are and what they are worth, against the population.

    Groups without Persuadables are left out.
    """
    whole = W.partitionBy("demographic")

    def share(name: str) -> Column:
        return fixed(ratio(F.col(name), F.sum(name).over(whole)) * 100, 1)

    shares = group_totals(segmented).withColumns(
        {"pct_of_persuadables": share("n_persuadable"), "pct_of_population": share("n_customers")}
    )
    return shares.where(F.col("n_persuadable") > 0).select(
        "demographic", "group", "n_persuadable",
        fixed(_mean("chosen_clv", "n_persuadable"), 2).alias("avg_clv"),
        fixed(F.col("chosen_value"), 2).alias("total_value_at_risk"),
        # Values are cents: without the noise of their sum, whose order is free, a mean between two cents has one rounding.
        fixed(ratio(fixed(F.col("chosen_value"), 4), F.col("n_persuadable")), 2).alias("avg_value_at_risk"),
        fixed(_mean("chosen_uplift", "n_persuadable"), 2).alias("avg_uplift"),
        "pct_of_persuadables", "pct_of_population",
        (F.abs(fixed(F.col("pct_of_persuadables") - F.col("pct_of_population"), 1)) > SHARE_POINTS).alias("flagged"),
    )


def fairness_report(segmented: DataFrame) -> DataFrame:
    """The summary kept on file: one row per demographic group."""
    return group_totals(segmented).select(
        "demographic", "group", "n_customers",
        fixed(_rate("Persuadable"), 1).alias("pct_persuadable"),
        fixed(_rate("Sleeping Dog"), 1).alias("pct_sleeping_dog"),
        fixed(_mean("uplift", "n_scored"), 4).alias("mean_uplift"),
        fixed(_mean("clv", "n_customers"), 2).alias("mean_clv"),
        fixed(F.col("value"), 2).alias("total_value_at_risk"),
    )
