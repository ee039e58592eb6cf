"""Reports over the five tables: modeling dataset, cohorts, arms, top customers, segments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions import customer
from holdfast.functions.numeric import fixed, mean_where, percent_of
from holdfast.operators.cuts import scan
from holdfast.operators.ranking import global_rank, tile, top_rows
from holdfast.operators.star import WITHOUT_SERVICES, star
from holdfast.schemas import MODELING_COLUMNS
from holdfast.session import store

Tables = Mapping[str, DataFrame]


def _treated() -> Column:
    return F.col("treatment") == 1


def _control() -> Column:
    return F.col("treatment") == 0


def _exposure() -> Column:
    return customer.revenue_at_risk(F.col("monthly_charges"), F.col("churn_binary"))


def _renamed(joined: DataFrame) -> DataFrame:
    return joined.withColumnsRenamed({"customer_lifetime_value": "clv", "marketing_offer_given": "treatment"})


def modeling_dataset(tables: Tables, ordered: bool = False) -> DataFrame:
    """All five tables as one row per customer with derived columns.

    ``ordered`` sorts by lifetime value, highest first, which costs a shuffle
    that only an export needs.
    """
    rows = _renamed(star(tables)).withColumns(
        {
            "num_premium_services": customer.premium_services(),
            "revenue_at_risk": fixed(_exposure(), 2),
            "tenure_bucket": customer.tenure_bucket(F.col("tenure_months")),
        }
    ).select(MODELING_COLUMNS)
    return rows.orderBy(F.desc("clv"), "customer_id") if ordered else rows


def tenure_cohorts(tables: Tables, tiles: int = 10) -> DataFrame:
    """Churn and offer rates by tenure decile; ties in tenure are ordered by customer_id."""
    rows = _renamed(star(tables, WITHOUT_SERVICES)).select(
        "customer_id", "tenure_months", "churn_binary", "treatment", "clv", "monthly_charges"
    )
    ranked = global_rank(rows, [F.col("tenure_months").asc(), F.col("customer_id").asc()])
    churned = F.col("churn_binary")
    return (
        ranked.groupBy(tile(F.col("rank"), F.col("n_rows"), tiles).alias("tenure_decile"))
        .agg(
            F.min("tenure_months").alias("min_tenure"),
            F.max("tenure_months").alias("max_tenure"),
            F.count("*").alias("customer_count"),
            fixed(percent_of(churned), 1).alias("churn_rate_pct"),
            fixed(mean_where(_treated(), churned) * 100, 1).alias("treated_churn_pct"),
            fixed(mean_where(_control(), churned) * 100, 1).alias("control_churn_pct"),
            fixed(percent_of(F.col("treatment")), 1).alias("treatment_rate_pct"),
            fixed(F.avg("clv"), 2).alias("avg_clv"),
            fixed(F.sum(_exposure()), 2).alias("total_revenue_at_risk"),
        )
        .orderBy("tenure_decile")
    )


def _arm_measures() -> list[Column]:
    return [
        F.count("*").alias("n_customers"),
        fixed(F.avg("churn_binary") * 100, 2).alias("churn_rate_pct"),
        fixed(F.avg("tenure_months"), 1).alias("avg_tenure"),
        fixed(F.avg("monthly_charges"), 2).alias("avg_monthly_charges"),
        fixed(F.avg("clv"), 2).alias("avg_clv"),
        fixed(F.avg("propensity_score"), 4).alias("avg_propensity"),
        fixed(F.sum(_exposure()), 2).alias("total_revenue_at_risk"),
    ]


def treatment_comparison(tables: Tables) -> DataFrame:
    """Treated against control customers, one scan and one aggregation."""
    rows = _renamed(star(tables, WITHOUT_SERVICES))
    arm = F.when(_treated(), "Treatment").when(_control(), "Control").alias("group_name")
    return rows.where(_treated() | _control()).groupBy(arm).agg(*_arm_measures())


def treatment_comparison_union(tables: Tables) -> DataFrame:
    """The same report as one filtered aggregate per arm, put together by union."""
    rows = _renamed(star(tables, WITHOUT_SERVICES))
    treated = rows.where(_treated()).agg(*_arm_measures()).select(F.lit("Treatment").alias("group_name"), "*")
    control = rows.where(_control()).agg(*_arm_measures()).select(F.lit("Control").alias("group_name"), "*")
    return treated.unionByName(control)


def high_value_customers(tables: Tables, k: int = 100) -> DataFrame:
    """The ``k`` customers with the highest lifetime value, with rank columns.

    The windows run over the ``k`` rows kept, not over all customers: every
    window value of the first ``k`` rows depends on those rows and the row count
    alone. ``clv_percentile`` is 0.0 for the highest value.
    """
    rows = _renamed(star(tables, WITHOUT_SERVICES)).select(
        "customer_id", "tenure_months", "contract_type", "monthly_charges", "clv",
        "treatment", "propensity_score", "churn_binary",
    )
    highest = [F.desc("clv"), F.asc("customer_id")]
    n_rows = rows.agg(F.count("*").alias("n"))
    w, by_value = W.orderBy(*highest), W.orderBy(F.desc("clv"))
    return (
        top_rows(rows, k, highest)
        .select(
            "*",
            fixed(customer.annual_revenue(F.col("monthly_charges")), 2).alias("annual_revenue"),
            F.row_number().over(w).alias("clv_rank"),
            fixed(
                F.coalesce(F.try_divide(F.rank().over(by_value) - 1.0, n_rows.scalar() - 1), F.lit(0.0)), 4
            ).alias("clv_percentile"),
            F.lag("clv", 1).over(w).alias("prev_customer_clv"),
            fixed(
                F.sum(_exposure()).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)), 2
            ).alias("cumulative_revenue_at_risk"),
        )
        .orderBy("clv_rank")
    )


def customers_by_value(tables: Tables) -> DataFrame:
    """Every customer with the columns of ``high_value_customers``, over all customers in order of lifetime value.

    Ranks, the value before and the running exposure are carried from block to
    block, so no task sees all rows and no limit is needed. Exposure is summed as
    a decimal. Eager, as ``scan`` is; the narrow rows are stored once.
    """
    rows = store(_renamed(star(tables, WITHOUT_SERVICES)).select(
        "customer_id", "tenure_months", "contract_type", "monthly_charges", "clv",
        "treatment", "propensity_score", "churn_binary",
    ))
    ranked = scan(
        rows, "clv", "customer_id", {"_exposed": _exposure().cast("decimal(18,4)")}, {"prev_customer_clv": "clv"},
        rank="clv_rank", peers="_least", total="_total",
    )
    return ranked.select(
        *rows.columns,
        fixed(customer.annual_revenue(F.col("monthly_charges")), 2).alias("annual_revenue"),
        "clv_rank",
        fixed(F.coalesce(F.try_divide(F.col("_least") - 1.0, F.col("_total") - 1), F.lit(0.0)), 4).alias("clv_percentile"),
        "prev_customer_clv",
        fixed(F.col("_exposed"), 2).alias("cumulative_revenue_at_risk"),
    )


def segment_analysis(tables: Tables, min_n: int = 50) -> DataFrame:
    """Churn and offer rates by contract and internet service, small segments left out."""
    rows = _renamed(star(tables))
    churned = F.col("churn_binary")
    return (
        rows.groupBy("contract_type", "internet_service")
        .agg(
            F.count("*").alias("n_customers"),
            fixed(F.avg(churned) * 100, 1).alias("churn_rate_pct"),
            fixed(F.avg("treatment") * 100, 1).alias("treatment_rate_pct"),
            fixed(mean_where(_treated(), churned) * 100, 1).alias("treated_churn_pct"),
            fixed(mean_where(_control(), churned) * 100, 1).alias("control_churn_pct"),
            fixed(F.avg("clv"), 2).alias("avg_clv"),
            fixed(F.sum(_exposure()), 2).alias("segment_revenue_at_risk"),
        )
        .where(F.col("n_customers") >= min_n)
        .orderBy(F.desc("churn_rate_pct"), "contract_type", "internet_service")
    )


def data_summary(modeling: DataFrame) -> DataFrame:
    """Size, rates and the raw churn gap between arms, in one pass."""
    churned = F.col("churn_binary")
    treated, control = mean_where(_treated(), churned), mean_where(_control(), churned)
    return modeling.agg(
        F.count("*").alias("n_customers"),
        fixed(F.avg(churned), 4).alias("churn_rate"),
        fixed(F.avg("treatment"), 4).alias("offer_rate"),
        fixed(F.avg("clv"), 2).alias("avg_clv"),
        fixed(F.avg("propensity_score"), 4).alias("avg_propensity"),
        fixed(treated, 4).alias("treated_churn"),
        fixed(control, 4).alias("control_churn"),
        fixed(treated - control, 4).alias("naive_difference"),
    )
