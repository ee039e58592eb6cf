"""Average effect of the offer: raw, and corrected by inverse-probability weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.customer import SCORE_CEILING, SCORE_FLOOR
from holdfast.functions.numeric import clip, fixed, mean_where, ratio

BALANCE_LIMIT = 0.10
# Wording of a direction.
REDUCES, INCREASES = "Offer REDUCES churn", "Offer INCREASES churn"

# Covariates of the propensity model, in order.
PROPENSITY_FEATURES = [
    "tenure_months", "monthly_charges", "total_charges", "senior_citizen",
    "contract_type", "internet_service", "payment_method", "partner",
    "dependents", "paperless_billing", "num_premium_services", "clv",
]


def _is_treated() -> Column:
    return F.col("treatment") == 1


def _is_control() -> Column:
    return F.col("treatment") == 0


def bounded_propensity(propensity: str) -> Column:
    return clip(F.col(propensity), SCORE_FLOOR, SCORE_CEILING)


def with_weights(df: DataFrame, propensity: str = "propensity_score") -> DataFrame:
    """Add w_treated = t/e and w_control = (1-t)/(1-e), with e held off 0 and 1."""
    e, t = bounded_propensity(propensity), F.col("treatment")
    return df.withColumns({"w_treated": t / e, "w_control": (1 - t) / (1 - e)})


def effect_estimates(df: DataFrame, propensity: str = "propensity_score") -> DataFrame:
    """Unrounded churn per arm and effects, raw and weighted, in one aggregation.

    The weighted means are normalised by the sum of weights in each arm.
    """
    y = F.col("churn_binary")

    def weighted(weight: str) -> Column:
        return ratio(F.sum(F.col(weight) * y), F.sum(weight))

    return (
        with_weights(df, propensity)
        .agg(
            mean_where(_is_treated(), y).alias("naive_treated_churn"),
            mean_where(_is_control(), y).alias("naive_control_churn"),
            weighted("w_treated").alias("ipw_treated_churn"),
            weighted("w_control").alias("ipw_control_churn"),
        )
        .withColumns(
            {
                "naive_ate": F.col("naive_control_churn") - F.col("naive_treated_churn"),
                "ipw_ate": F.col("ipw_control_churn") - F.col("ipw_treated_churn"),
            }
        )
    )


def ate_comparison(df: DataFrame, propensity: str = "propensity_score", digits: int = 6) -> DataFrame:
    """Raw against weighted effect, how far the correction moved it, and both directions."""
    estimates = effect_estimates(df, propensity)

    def direction(effect: str) -> Column:
        return F.when(F.col(effect) > 0, REDUCES).otherwise(INCREASES)

    return estimates.select(
        *[fixed(F.col(name), digits).alias(name) for name in estimates.columns],
        fixed(F.abs(F.col("ipw_ate") - F.col("naive_ate")), digits).alias("shift"),
        direction("naive_ate").alias("naive_direction"),
        direction("ipw_ate").alias("ipw_direction"),
    )


def weight_diagnostics(df: DataFrame, propensity: str = "propensity_score") -> DataFrame:
    """Size of the weights and the effective number of rows they leave."""
    e = bounded_propensity(propensity)
    w = F.when(_is_treated(), 1 / e).otherwise(1 / (1 - e))
    return df.agg(
        F.count("*").alias("n_rows"),
        fixed(F.avg(w), 4).alias("mean_weight"),
        fixed(F.max(w), 4).alias("max_weight"),
        fixed(F.min(w), 4).alias("min_weight"),
        fixed(ratio(F.pow(F.sum(w), F.lit(2)), F.sum(w * w)), 4).alias("effective_n"),
    )


def covariate_balance(
    df: DataFrame, features: Sequence[str], propensity: str = "propensity_score"
) -> DataFrame:
    """Standardised mean difference per numeric feature before and after weighting.

    Both are divided by the unweighted pooled spread; a constant feature gives 0.
    One aggregation by arm measures all features without expanding rows.
    """
    e = bounded_propensity(propensity)
    weight = F.when(_is_treated(), 1 / e).otherwise(1 / (1 - e))
    rows = df.where(_is_treated() | _is_control()).select(
        "treatment", weight.alias("_w"), *[F.col(name).cast("double").alias(f"_x{i}") for i, name in enumerate(features)]
    )
    measures = [F.sum("_w").alias("_w")]
    for i in range(len(features)):
        x = F.col(f"_x{i}")
        measures += [F.avg(x).alias(f"_m{i}"), F.var_pop(x).alias(f"_v{i}"), F.sum(F.col("_w") * x).alias(f"_s{i}")]
    lines = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"_m{i}").alias("_mean"),
            F.col(f"_v{i}").alias("_variance"),
            ratio(F.col(f"_s{i}"), F.col("_w")).alias("_weighted_mean"),
        )
        for i, name in enumerate(features)
    ]
    # Two rows per feature from here on.
    arms = rows.groupBy("treatment").agg(*measures).select("treatment", F.inline(F.array(*lines)))

    def of(arm: Column, name: str) -> Column:
        return F.max(F.when(arm, F.col(name)))

    def gap(name: str) -> Column:
        return F.abs(of(_is_treated(), name) - of(_is_control(), name))

    spread = F.sqrt((of(_is_treated(), "_variance") + of(_is_control(), "_variance")) / 2)
    found = arms.groupBy("feature").agg(
        F.when(spread > 0, gap("_mean") / spread).otherwise(0.0).alias("_raw"),
        F.when(spread > 0, gap("_weighted_mean") / spread).otherwise(0.0).alias("_ipw"),
    )
    return found.select(
        "feature",
        fixed(F.col("_raw"), 6).alias("smd_raw"),
        fixed(F.col("_ipw"), 6).alias("smd_ipw"),
        (F.col("_raw") < BALANCE_LIMIT).alias("balanced_before"),
        (F.col("_ipw") < BALANCE_LIMIT).alias("balanced_after"),
    )


def balance_summary(balance: DataFrame) -> DataFrame:
    """How many features were balanced before and after, and whether weighting helped."""
    before, after = F.count_if("balanced_before"), F.count_if("balanced_after")
    return balance.agg(
        F.count("*").alias("n_features"),
        before.alias("n_balanced_before"),
        after.alias("n_balanced_after"),
        (after > before).alias("improved"),
    )
