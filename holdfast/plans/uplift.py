"""Uplift per customer, segments, and the summaries read from them.

Outcome 1 is churn, so a positive uplift means the offer helps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions import segments
from holdfast.functions.customer import SCORE_CEILING, SCORE_FLOOR
from holdfast.functions.numeric import clip, fixed, mean_where, percent_of, ratio, sum_where
from holdfast.operators.attach import attach
from holdfast.operators.quantiles import median

CELLS = ("contract_type", "internet_service", "tenure_band")
EFFECT_CELLS = ("contract_type", "internet_service")


def with_tenure_band(df: DataFrame) -> DataFrame:
    tenure = F.col("tenure_months")
    return df.withColumn("tenure_band", F.when(tenure <= 24, "0-24").when(tenure <= 48, "25-48").otherwise("49+"))


def cell_counts(df: DataFrame, cells: Sequence[str] = CELLS) -> DataFrame:
    """Customers and churned customers per cell and arm: all a saturated learner needs."""
    t, y = F.col("treatment"), F.col("churn_binary")
    return df.groupBy(*cells).agg(
        F.sum(1 - t).alias("n_c"), F.sum(t).alias("n_t"), F.sum((1 - t) * y).alias("y_c"), F.sum(t * y).alias("y_t")
    )


def _means(counts: DataFrame, mu_0: str, mu_1: str) -> DataFrame:
    return counts.withColumns(
        {mu_0: ratio(F.col("y_c"), F.col("n_c")), mu_1: ratio(F.col("y_t"), F.col("n_t"))}
    )


def fit_cell_means(df: DataFrame, cells: Sequence[str] = CELLS) -> DataFrame:
    """Churn rate per cell in each arm: the two-model learner with saturated models.

    An arm without rows in a cell gives null.
    """
    return _means(cell_counts(df, cells), "mu_0_control", "mu_1_treatment").drop("n_c", "n_t", "y_c", "y_t")


def score_by_cells(modeling: DataFrame, cells: Sequence[str] = CELLS) -> DataFrame:
    """Modeling rows with mu_0_control, mu_1_treatment and uplift_score from cell means."""
    rows = with_tenure_band(modeling)
    scored = attach(rows, fit_cell_means(rows, cells), cells)
    return scored.drop("tenure_band").withColumn("uplift_score", F.col("mu_0_control") - F.col("mu_1_treatment"))


def fit_crossed_cells(
    df: DataFrame, cells: Sequence[str] = CELLS, effect_cells: Sequence[str] = EFFECT_CELLS, suffix: str = "_xl"
) -> DataFrame:
    """The cross-imputed learner with saturated models: means and effects per cell.

    Effects are imputed with the other arm's cell mean and averaged within each
    arm over the wider effect cells. The counts per cell suffice, so the rows are
    read once. Cells where the other arm is empty give no effects.
    """
    mu_0, mu_1 = f"mu_0{suffix}", f"mu_1{suffix}"
    wide = W.partitionBy(*effect_cells)

    def mean_effect(effects: Column, size: str) -> Column:
        return ratio(F.sum(effects).over(wide), F.sum(F.when(effects.isNotNull(), F.col(size))).over(wide))

    on_treated = F.col("y_t") - F.col("n_t") * F.col(mu_0)
    on_control = F.col("n_c") * F.col(mu_1) - F.col("y_c")
    return _means(cell_counts(df, cells), mu_0, mu_1).select(
        *cells, mu_0, mu_1,
        mean_effect(on_treated, "n_t").alias("_tau_1"),
        mean_effect(on_control, "n_c").alias("_tau_0"),
    )


def score_by_crossed_cells(
    modeling: DataFrame, cells: Sequence[str] = CELLS, effect_cells: Sequence[str] = EFFECT_CELLS, suffix: str = "_xl"
) -> DataFrame:
    """Modeling rows with the crossed learner's outcomes, and its effects mixed by the clipped propensity."""
    rows = with_tenure_band(modeling)
    scored = attach(rows, fit_crossed_cells(rows, cells, effect_cells, suffix), cells)
    uplift = combine_effects(F.col("_tau_0"), F.col("_tau_1"), F.col("propensity_score"))
    return scored.select(*modeling.columns, uplift.alias(f"uplift_score{suffix}"), f"mu_0{suffix}", f"mu_1{suffix}")


def combine_effects(tau_0: Column, tau_1: Column, propensity: Column) -> Column:
    """Propensity-weighted effect with its sign turned, so positive helps."""
    e = clip(propensity, SCORE_FLOOR, SCORE_CEILING)
    return -(e * tau_0 + (1 - e) * tau_1)


def segment(
    scored: DataFrame,
    risk_threshold: float | Column | None = None,
    uplift: str = "uplift_score",
    risk: str = "mu_0_control",
    suffix: str = "",
    key: str = "customer_id",
) -> DataFrame:
    """Add quadrant and value_at_risk (in cents precision).

    Without a threshold, the exact median of the baseline risk is used.
    """
    if risk_threshold is None:
        risk_threshold = median(scored, risk, key).scalar()
    score, baseline = F.col(uplift), F.col(risk)
    return scored.withColumns(
        {
            f"quadrant{suffix}": segments.quadrant(score, baseline, risk_threshold),
            f"value_at_risk{suffix}": fixed(segments.value_at_risk(F.col("clv"), score), 2),
        }
    )


def score_distribution(scored: DataFrame, uplift: str = "uplift_score", key: str = "customer_id") -> DataFrame:
    """Mean, median, range, population spread and sign shares of a score."""
    score = F.col(uplift)
    middle = median(scored, uplift, key)
    return scored.agg(
        F.count(score).alias("n_scored"),
        fixed(F.avg(score), 6).alias("mean_uplift"),
        fixed(F.min(score), 6).alias("min_uplift"),
        fixed(F.max(score), 6).alias("max_uplift"),
        fixed(F.stddev_pop(score), 6).alias("std_uplift"),
        F.count_if(score > 0).alias("n_positive"),
        F.count_if(score < 0).alias("n_negative"),
        fixed(percent_of(score > 0), 2).alias("pct_positive"),
        fixed(percent_of(score < 0), 2).alias("pct_negative"),
    ).withColumn("median_uplift", fixed(middle.scalar(), 6))


def quadrant_summary(segmented: DataFrame) -> DataFrame:
    """Size, share, averages and value of each quadrant that has rows."""
    return (
        segmented.groupBy("quadrant")
        .agg(
            F.count("*").alias("n_customers"),
            fixed(F.avg("uplift_score"), 4).alias("avg_uplift"),
            fixed(F.avg("clv"), 2).alias("avg_clv"),
            fixed(F.sum("value_at_risk"), 2).alias("total_value_at_risk"),
        )
        .withColumn("pct_customers", fixed(F.col("n_customers") * 100.0 / F.sum("n_customers").over(W.partitionBy()), 1))
    )


def value_at_stake(segmented: DataFrame) -> DataFrame:
    """Value to save among Persuadables and value contacting Sleeping Dogs would destroy."""
    value, name = F.col("value_at_risk"), F.col("quadrant")
    return segmented.agg(
        F.count_if(name == "Persuadable").alias("n_persuadable"),
        fixed(sum_where(name == "Persuadable", value), 2).alias("saveable_value"),
        F.count_if(name == "Sleeping Dog").alias("n_sleeping_dog"),
        fixed(F.abs(sum_where(name == "Sleeping Dog", value)), 2).alias("destroyable_value"),
    )


def value_by_quadrant(segmented: DataFrame) -> DataFrame:
    return (
        segmented.groupBy("quadrant")
        .agg(fixed(F.sum("value_at_risk"), 2).alias("total_value_at_risk"))
        .orderBy(F.desc("total_value_at_risk"), "quadrant")
    )


def quadrant_counts(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("quadrant").agg(F.count("*").alias("n_customers")).orderBy(F.desc("n_customers"), "quadrant")


def segment_deep_dive(segmented: DataFrame) -> DataFrame:
    """Churn, uplift and value by contract and by internet service, in one pass.

    Rows are summed by both columns together, and only those sums are split by
    dimension. Rates are rounded to four places and then again as percentages.
    """
    both = segmented.groupBy("contract_type", "internet_service").agg(
        F.count("*").alias("_n"),
        F.sum("churn_binary").alias("_churned"),
        F.sum("uplift_score").alias("_uplift"),
        F.count("uplift_score").alias("_scored"),
        F.sum("value_at_risk").alias("_value"),
    )
    dimension = F.inline(
        F.array(
            F.struct(F.lit("contract_type").alias("dimension"), F.col("contract_type").alias("segment")),
            F.struct(F.lit("internet_service").alias("dimension"), F.col("internet_service").alias("segment")),
        )
    )

    def rate(total: str, count: str) -> Column:
        return fixed(ratio(F.sum(total), F.sum(count)), 4) * 100

    return (
        both.select("_n", "_churned", "_uplift", "_scored", "_value", dimension)
        .groupBy("dimension", "segment")
        .agg(
            F.sum("_n").alias("customers"),
            fixed(rate("_churned", "_n"), 1).alias("churn_rate_pct"),
            fixed(rate("_uplift", "_scored"), 2).alias("avg_uplift_pct"),
            fixed(F.sum("_value"), 0).alias("total_value"),
        )
    )


def executive_kpis(segmented: DataFrame) -> DataFrame:
    """Headline figures in one aggregation; averages of empty segments are zero."""
    value, name = F.col("value_at_risk"), F.col("quadrant")
    persuadable, sleeping = name == "Persuadable", name == "Sleeping Dog"
    return segmented.agg(
        fixed(sum_where(F.col("churn_binary") == 1, F.col("revenue_at_risk")), 2).alias("total_revenue_at_risk"),
        F.count_if(persuadable).alias("persuadable_count"),
        fixed(sum_where(persuadable, value), 2).alias("persuadable_value"),
        F.count_if(sleeping).alias("sleeping_dog_count"),
        fixed(F.abs(sum_where(sleeping, value)), 2).alias("sleeping_dog_value"),
        fixed(F.coalesce(mean_where(persuadable, F.col("uplift_score")), F.lit(0.0)), 4).alias("avg_persuadable_uplift"),
    )
