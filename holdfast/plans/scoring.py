"""Score customer requests: validate, derive features, predict, explain.

No step moves or aggregates rows, so a stream and a batch run the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from holdfast.functions import customer, segments
from holdfast.functions.numeric import fixed, sum_where
from holdfast.schemas import QUADRANTS, REQUEST, REQUEST_DEFAULTS, REQUEST_RANGES, REQUEST_VALUES
from holdfast.operators.checks import in_range, in_set, row_checks
from holdfast.sources.rescued import RECORD, RESCUED

# Adds mu_0_control and mu_1_treatment to rows that carry the features.
Outcomes = Callable[[DataFrame], DataFrame]


def request_errors(rescued: bool = False) -> Column:
    """What is wrong with a request, one text per broken rule; empty if nothing.

    With ``rescued`` the requests were read without loss: a field of another type
    is told from a missing one, and a record that cannot be read from an empty one.
    """
    found = []
    for name in REQUEST.fieldNames():
        if name == "customer_id":
            continue
        value, odd = F.col(name), F.map_contains_key(RESCUED, name) if rescued else F.lit(False)
        if rescued and REQUEST[name].dataType != StringType():
            found.append(F.when(odd, f"{name} has the wrong type"))
        found.append(F.when(value.isNull() & ~odd, f"{name} is required"))
        if name in REQUEST_VALUES:
            found.append(F.when(~value.isin(REQUEST_VALUES[name]), f"{name} is not an allowed value"))
        if name in REQUEST_RANGES:
            low, high = REQUEST_RANGES[name]
            inside = value >= low if high is None else value.between(low, high)
            found.append(F.when(~inside, f"{name} is out of range"))
    errors = F.array_compact(F.array(*found))
    if rescued:
        errors = F.when(F.map_contains_key(RESCUED, RECORD), F.array(F.lit("the record cannot be read"))).otherwise(errors)
    return errors


def with_errors(requests: DataFrame) -> DataFrame:
    """Requests with defaults filled in and an ``errors`` column; ``rescued`` tells more where the reader gave it."""
    return requests.fillna(REQUEST_DEFAULTS).withColumn("errors", request_errors(RESCUED in requests.columns))


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined); the quarantined keep their errors."""
    checked = with_errors(requests)
    broken = F.size("errors") > 0
    return checked.where(~broken).drop("errors"), checked.where(broken)


def with_features(requests: DataFrame) -> DataFrame:
    """Features the learners expect. A supplied clv or propensity_score is kept.

    Without one, lifetime value has no noise and the propensity is rule-based.
    """
    tenure, monthly, contract = F.col("tenure_months"), F.col("monthly_charges"), F.col("contract_type")
    derived = {"num_premium_services": customer.premium_services()}
    if "clv" not in requests.columns:
        derived["clv"] = customer.lifetime_value(monthly, tenure, contract, customer.DEFAULT_CONTRACT_MONTHS)
    if "propensity_score" not in requests.columns:
        derived["propensity_score"] = customer.risk_score(tenure, monthly, contract)
    return requests.withColumns(derived)


def responses(outcomes: DataFrame, risk_threshold: float = segments.SERVING_RISK) -> DataFrame:
    """The nine response columns. Values are rounded only here, after all decisions."""
    risk, offered = F.col("mu_0_control"), F.col("mu_1_treatment")
    rows = outcomes.withColumn("_uplift", risk - offered)
    uplift = F.col("_uplift")
    rows = rows.withColumns(
        {
            "quadrant": segments.quadrant(uplift, risk, risk_threshold),
            "value_at_risk": fixed(segments.value_at_risk(F.col("clv"), uplift), 2),
        }
    )
    return rows.select(
        "customer_id",
        fixed(risk, 4).alias("churn_risk"),
        fixed(offered, 4).alias("churn_risk_with_offer"),
        fixed(uplift, 4).alias("uplift_score"),
        "quadrant",
        fixed(F.col("clv"), 2).alias("customer_lifetime_value"),
        "value_at_risk",
        segments.recommendation(F.col("quadrant"), uplift, risk, F.col("value_at_risk")).alias("recommendation"),
        segments.confidence(uplift).alias("confidence"),
    )


def score_requests(valid: DataFrame, outcomes: Outcomes, risk_threshold: float = segments.SERVING_RISK) -> DataFrame:
    """Valid requests to responses. The threshold is stored, never taken from the batch."""
    return responses(outcomes(with_features(valid)), risk_threshold)


def score_batch(
    requests: DataFrame, outcomes: Outcomes, risk_threshold: float = segments.SERVING_RISK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(responses, totals, quarantined) of a batch of any size; bad rows do not stop it."""
    valid, quarantined = split_requests(requests)
    scored = score_requests(valid, outcomes, risk_threshold)
    return scored, batch_totals(scored), quarantined


def batch_totals(scored: DataFrame) -> DataFrame:
    """Counts and values over scored rows, in one aggregation."""
    value, name = F.col("value_at_risk"), F.col("quadrant")
    return scored.agg(
        F.count("*").alias("total_customers"),
        fixed(F.coalesce(F.sum(value), F.lit(0.0)), 2).alias("total_revenue_at_risk"),
        F.count_if(name == "Persuadable").alias("persuadable_count"),
        fixed(sum_where(name == "Persuadable", value), 2).alias("persuadable_revenue"),
        F.count_if(name == "Sleeping Dog").alias("sleeping_dog_count"),
    )


def check_responses(scored: DataFrame) -> DataFrame:
    """(check, n_bad, passed) for the promised ranges and values of responses."""
    return row_checks(
        scored,
        {
            "churn_risk in [0,1]": in_range("churn_risk", 0, 1),
            "churn_risk_with_offer in [0,1]": in_range("churn_risk_with_offer", 0, 1),
            "uplift_score not null": F.col("uplift_score").isNull(),
            "quadrant known": in_set("quadrant", QUADRANTS),
            "customer_lifetime_value >= 0": in_range("customer_lifetime_value", 0),
            "value_at_risk not null": F.col("value_at_risk").isNull(),
            "confidence known": in_set("confidence", ["high", "medium", "low"]),
        },
    )
