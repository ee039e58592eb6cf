"""Every registered query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from conftest import MEDIUM, SMALL

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["q2_tenure_cohorts", "q4_high_value_customers", "q5_segment_analysis", "qini_curve", "uplift_at_k"])
def test_query_equals_sql_on_more_rows(spark, name):
    assert differences(QUERIES[name](spark, MEDIUM), connect(MEDIUM), ORACLES[name]) == []


@pytest.mark.parametrize("name", ["offer_assignment", "approximate_percentiles_by_contract"])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 9
