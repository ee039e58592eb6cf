"""Who a budget reaches, and what the campaign returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.display import dollars, percent
from holdfast.functions.numeric import fixed, ratio
from holdfast.operators.cuts import first_rows
from holdfast.operators.ranking import global_rank, top_rows
from holdfast.sources.files import keep_columns

# Columns of the target list, in order.
LIST_COLUMNS = [
    "customer_id", "contract_type", "internet_service", "tenure_months", "monthly_charges",
    "clv", "uplift_score", "quadrant", "value_at_risk",
]
EXCELLENT_RETURN = 100
SHOWN_ROWS = 50


def eligible_targets(
    segmented: DataFrame,
    min_uplift: float = 0.01,
    contracts: Sequence[str] | None = None,
    internet: Sequence[str] | None = None,
) -> DataFrame:
    """Persuadables with enough uplift in the chosen segments; None chooses all."""
    rows = segmented.where((F.col("quadrant") == "Persuadable") & (F.col("uplift_score") >= min_uplift))
    if contracts is not None:
        rows = rows.where(F.col("contract_type").isin(list(contracts)))
    if internet is not None:
        rows = rows.where(F.col("internet_service").isin(list(internet)))
    return rows


def affordable(budget: float, cost_per_contact: float) -> int:
    return int(budget / cost_per_contact)


def _order() -> list[Column]:
    return [F.desc("value_at_risk"), F.asc("customer_id")]


def select_targets(eligible: DataFrame, budget: float, cost_per_contact: float, spread: bool = False) -> DataFrame:
    """The most valuable targets the budget pays for, in order; ``spread`` for lists too long for one task."""
    if spread:
        return placed_targets(eligible, budget, cost_per_contact).orderBy("place").drop("place")
    return top_rows(eligible, affordable(budget, cost_per_contact), _order())


def placed_targets(eligible: DataFrame, budget: float, cost_per_contact: float) -> DataFrame:
    """The same targets for lists of any length, each with its place in the list.

    The last target that the budget pays for is found by cuts, so only the chosen
    rows are moved and stored. Eager, as ``first_rows`` and ``global_rank`` are.
    """
    most = affordable(budget, cost_per_contact)
    chosen = first_rows(eligible, most, "value_at_risk", "customer_id")
    return global_rank(chosen, _order(), rank="place", total="_total").drop("_total")


def campaign_return(eligible: DataFrame, budget: float, cost_per_contact: float) -> DataFrame:
    """One row: contacts, cost, savings, return in percent, and a verdict."""
    selected = select_targets(eligible.select("customer_id", "value_at_risk"), budget, cost_per_contact)
    n_eligible = eligible.agg(F.count("*").alias("n")).scalar()
    row = selected.agg(
        F.count("*").alias("n_selected"), F.coalesce(F.sum("value_at_risk"), F.lit(0.0)).alias("_savings")
    ).select(
        "n_selected", n_eligible.alias("n_eligible"), (F.col("n_selected") * float(cost_per_contact)).alias("_cost"), "_savings"
    )
    roi = F.coalesce((ratio(F.col("_savings"), F.col("_cost")) - 1) * 100, F.lit(0.0))
    return row.select(
        "n_selected", "n_eligible",
        (F.col("n_eligible") - F.col("n_selected")).alias("n_remaining"),
        F.col("_cost").alias("campaign_cost"),
        fixed(F.col("_savings"), 2).alias("projected_savings"),
        fixed(roi, 1).alias("roi_pct"),
        fixed(ratio(F.col("_savings"), F.col("_cost")), 2).alias("saved_per_dollar"),
        F.when(roi > EXCELLENT_RETURN, "excellent").when(roi > 0, "positive").otherwise("negative").alias("verdict"),
    )


def target_list(selected: DataFrame) -> DataFrame:
    """The columns a campaign tool takes, with plain numbers."""
    return keep_columns(selected, LIST_COLUMNS)


def target_list_display(selected: DataFrame, shown: int = SHOWN_ROWS) -> DataFrame:
    """The first rows of the list with amounts and shares as text."""
    texts = {
        "uplift_score": percent(F.col("uplift_score"), 1),
        "clv": dollars(F.col("clv"), 0),
        "value_at_risk": dollars(F.col("value_at_risk"), 0),
        "monthly_charges": dollars(F.col("monthly_charges"), 2, grouped=False),
    }
    rows = top_rows(target_list(selected), shown, [F.desc("value_at_risk"), F.asc("customer_id")])
    return rows.withColumns({name: text for name, text in texts.items() if name in rows.columns})
