"""Action segments and what a marketing team reads about them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast.functions.display import dollars, percent, signed_percent

# Cut-offs of the segments and confidence bands.
MIN_UPLIFT = 0.01
SERVING_RISK = 0.27
HIGH_CONFIDENCE, MEDIUM_CONFIDENCE = 0.15, 0.05


def quadrant(uplift: Column, risk: Column, risk_threshold: Column | float = SERVING_RISK) -> Column:
    """Segment of a customer; all comparisons are strict.

    A null uplift (a learner with no answer) is a Lost Cause.
    """
    helped = uplift > MIN_UPLIFT
    return (
        F.when(helped & (risk > risk_threshold), "Persuadable")
        .when(helped & (risk <= risk_threshold), "Sure Thing")
        .when(uplift < -MIN_UPLIFT, "Sleeping Dog")
        .otherwise("Lost Cause")
    )


def value_at_risk(clv: Column, uplift: Column) -> Column:
    """Lifetime value the offer saves (or destroys), unrounded."""
    return clv * uplift


def confidence(uplift: Column) -> Column:
    size = F.abs(uplift)
    return F.when(size > HIGH_CONFIDENCE, "high").when(size > MEDIUM_CONFIDENCE, "medium").otherwise("low")


def recommendation(segment: Column, uplift: Column, risk: Column, value: Column) -> Column:
    """Plain-language advice per segment."""
    # Wording and number formats of the advice.
    persuadable = F.concat(
        F.lit("HIGH PRIORITY: Target with retention offer. This customer has a "), percent(risk, 0),
        F.lit(" chance of churning without intervention, but the offer could reduce it by "), percent(uplift, 0),
        F.lit(". Potential savings: "), dollars(value, 0), F.lit("."),
    )
    sure_thing = F.concat(
        F.lit("LOW PRIORITY: Customer is likely to stay regardless. Churn risk is only "), percent(risk, 0),
        F.lit(". Save your budget for Persuadable customers."),
    )
    sleeping_dog = F.concat(
        F.lit("DO NOT CONTACT: Marketing outreach would INCREASE churn risk by "), percent(F.abs(uplift), 0),
        F.lit(". This customer is better left alone. Contacting them could destroy "), dollars(F.abs(value), 0),
        F.lit(" in value."),
    )
    lost_cause = F.concat(
        F.lit("DEPRIORITIZE: Customer has "), percent(risk, 0),
        F.lit(" churn risk and the offer has minimal effect (uplift: "), signed_percent(uplift, 2),
        F.lit("). Reallocate resources to Persuadable segment."),
    )
    return (
        F.when(segment == "Persuadable", persuadable)
        .when(segment == "Sure Thing", sure_thing)
        .when(segment == "Sleeping Dog", sleeping_dog)
        .otherwise(lost_cause)
    )
