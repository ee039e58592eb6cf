"""Per-customer features."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast.functions.numeric import clip, yes_flag
from holdfast.schemas import PREMIUM_SERVICES

# Months a contract is expected to run on.
CONTRACT_MONTHS = {"Month-to-month": 6, "One year": 14, "Two year": 26}
DEFAULT_CONTRACT_MONTHS = 6

# Upper ends and labels of the tenure buckets.
TENURE_BUCKETS = [(12, "0-12 months"), (24, "13-24 months"), (48, "25-48 months")]
LAST_TENURE_BUCKET = "49+ months"

# Risk points, and the range scores are held in.
SHORT_TENURE, SHORT_TENURE_POINTS = 24, 0.3
HIGH_CHARGES, HIGH_CHARGES_POINTS = 70, 0.2
RISKY_CONTRACT, RISKY_CONTRACT_POINTS = "Month-to-month", 0.3
CHURNED_POINTS = 0.15
SCORE_FLOOR, SCORE_CEILING = 0.05, 0.95


def premium_services(columns: list[str] | None = None) -> Column:
    """How many of the six add-on services are ``Yes``; a missing one counts as no."""
    return reduce(add, [yes_flag(F.col(name)) for name in columns or PREMIUM_SERVICES])


def tenure_bucket(tenure: Column) -> Column:
    label = F
    for upper, name in TENURE_BUCKETS:
        label = label.when(tenure <= upper, name)
    return label.otherwise(LAST_TENURE_BUCKET)


def annual_revenue(monthly: Column) -> Column:
    return monthly * 12


def revenue_at_risk(monthly: Column, churned: Column) -> Column:
    """A year of charges for a customer who churned, else zero. Unrounded."""
    return monthly * 12 * churned


def contract_months(contract: Column, default: int | None = None) -> Column:
    """Expected months by contract; unknown contracts give ``default`` (null if unset)."""
    pairs = [F.lit(part) for pair in CONTRACT_MONTHS.items() for part in pair]
    found = F.try_element_at(F.create_map(*pairs), contract)
    return found if default is None else F.coalesce(found, F.lit(default))


def lifetime_value(monthly: Column, tenure: Column, contract: Column, default: int | None = None) -> Column:
    """Monthly charges times expected months, unrounded.

    ``default`` covers unknown contracts: serving uses 6, training leaves null.
    """
    return monthly * (F.log1p(tenure.cast("double")) * 3 + contract_months(contract, default))


def risk_score(tenure: Column, monthly: Column, contract: Column, churned: Column | None = None) -> Column:
    """Rule-based offer propensity; the training variant also counts past churn."""
    score = (
        F.when(tenure < SHORT_TENURE, SHORT_TENURE_POINTS).otherwise(0.0)
        + F.when(monthly > HIGH_CHARGES, HIGH_CHARGES_POINTS).otherwise(0.0)
        + F.when(contract == RISKY_CONTRACT, RISKY_CONTRACT_POINTS).otherwise(0.0)
    )
    if churned is not None:
        score = score + churned * F.lit(CHURNED_POINTS)
    return clip(score, SCORE_FLOOR, SCORE_CEILING)


def senior_label(senior: Column) -> Column:
    return F.when(senior == 0, "Non-Senior").when(senior == 1, "Senior")


def hashed_assignment(key: Column, probability: Column, seed: int = 42) -> Column:
    """1 with the given probability, decided by the first 32 bits of md5("key:seed"): repeatable on any engine."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32
    return (draw < probability).cast("int")


def high_risk_flag(risk: Column, limit: Column | float) -> Column:
    """1 for a risk above the limit, which is meant to be a percentile of all risks."""
    return (risk > limit).cast("int")
