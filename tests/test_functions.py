"""Column expressions at their edges."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.functions import customer, segments
from holdfast.functions.numeric import clip, fixed, lenient_number, ratio, yes_flag


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_blank_charges_become_zero(spark):
    rows = spark.createDataFrame([(1, " "), (2, "29.85"), (3, None)], "id int, t string")
    got = rows.orderBy("id").select(F.coalesce(lenient_number(F.col("t")), F.lit(0.0)).alias("v")).collect()
    assert [r.v for r in got] == [0.0, 29.85, 0.0]


def test_quadrant_edges(spark):
    rows = spark.createDataFrame(
        [
            (0.01, 0.9, "Lost Cause"), (-0.01, 0.9, "Lost Cause"), (0.0, 0.1, "Lost Cause"),
            (0.0101, 0.5, "Sure Thing"), (0.0101, 0.5001, "Persuadable"), (0.3, 0.1, "Sure Thing"),
            (-0.0101, 0.9, "Sleeping Dog"), (-0.5, 0.1, "Sleeping Dog"), (None, 0.9, "Lost Cause"),
        ],
        "u double, r double, expected string",
    )
    got = rows.select("expected", segments.quadrant(F.col("u"), F.col("r"), 0.5).alias("q")).collect()
    assert all(r.expected == r.q for r in got)


def test_confidence_edges(spark):
    rows = spark.createDataFrame([(0.15,), (-0.1501,), (0.05,), (-0.0501,), (0.0,)], "u double")
    assert [r.c for r in rows.select(segments.confidence(F.col("u")).alias("c")).collect()] == [
        "medium", "high", "low", "medium", "low",
    ]


@pytest.mark.parametrize(
    "quadrant,uplift,risk,value",
    [("Persuadable", 0.125, 0.625, 1234.5), ("Sure Thing", 0.2, 0.005, 9.5), ("Sleeping Dog", -0.345, 0.5, -98765.5),
     ("Lost Cause", 0.004567, 0.335, 2.0), ("Lost Cause", -0.00999, 0.015, -2.5)],
)
def test_recommendation_numbers_read_as_python_writes_them(spark, quadrant, uplift, risk, value):
    text = one(spark, segments.recommendation(F.lit(quadrant), F.lit(uplift), F.lit(risk), F.lit(value)))
    expected = {
        "Persuadable": [f"a {risk:.0%} chance", f"by {uplift:.0%}.", f"${value:,.0f}."],
        "Sure Thing": [f"only {risk:.0%}."],
        "Sleeping Dog": [f"by {abs(uplift):.0%}.", f"${abs(value):,.0f} in"],
        "Lost Cause": [f"has {risk:.0%} churn", f"{uplift:+.2%})"],
    }[quadrant]
    assert all(part in text for part in expected), text


def test_lifetime_value_and_unknown_contracts(spark):
    def value(contract, default=None):
        return one(spark, customer.lifetime_value(F.lit(50.0), F.lit(11), F.lit(contract), default))

    assert value("One year") == pytest.approx(50 * (3 * math.log1p(11) + 14))
    assert value("Weekly") is None
    assert value("Weekly", 6) == pytest.approx(50 * (3 * math.log1p(11) + 6))


def test_risk_score_is_held_in_range(spark):
    def score(tenure, monthly, contract, churned=None):
        arm = None if churned is None else F.lit(churned)
        return one(spark, customer.risk_score(F.lit(tenure), F.lit(monthly), F.lit(contract), arm))

    assert score(24, 70.0, "Two year") == 0.05
    assert score(23, 70.5, "Month-to-month") == pytest.approx(0.8)
    assert score(23, 70.5, "Month-to-month", 1) == 0.95


def test_tenure_buckets(spark):
    rows = spark.createDataFrame([(0,), (12,), (13,), (24,), (25,), (48,), (49,)], "t int")
    assert [r.b for r in rows.select(customer.tenure_bucket(F.col("t")).alias("b")).collect()] == [
        "0-12 months", "0-12 months", "13-24 months", "13-24 months", "25-48 months", "25-48 months", "49+ months",
    ]


def test_premium_services_count_missing_as_no(spark):
    rows = spark.createDataFrame([("Yes", None, "No internet service")], "a string, b string, c string")
    assert rows.select(customer.premium_services(["a", "b", "c"]).alias("n")).first().n == 1


def test_hashed_assignment_is_repeatable_and_near_its_rate(spark):
    rows = spark.range(20_000).select(customer.hashed_assignment(F.col("id"), F.lit(0.3)).alias("t"))
    rate = rows.agg(F.avg("t")).first()[0]
    assert abs(rate - 0.3) < 0.02 and rows.agg(F.avg("t")).first()[0] == rate


def test_small_numbers(spark):
    assert one(spark, clip(F.lit(2.0), 0.05, 0.95)) == 0.95
    assert one(spark, clip(F.lit(None).cast("double"), 0.05, 0.95)) is None
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, yes_flag(F.lit(None).cast("string"))) == 0
    assert one(spark, fixed(F.lit(1.005), 2)) == 1.01
    assert one(spark, fixed(F.lit(-2.5), 0)) == -3.0
    assert np.isnan(one(spark, fixed(F.lit(float("nan")), 2)))
    assert one(spark, fixed(F.lit(1e27), 2)) == 1e27 and one(spark, fixed(F.lit(None), 2)) is None
    assert one(spark, fixed(F.lit(0.0049999999999996), 2)) == 0.0
