"""The five tables joined on customer_id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame

KEY = "customer_id"
ALL_TABLES = ("customers", "services", "billing", "marketing", "churn_labels")
WITHOUT_SERVICES = ("customers", "billing", "marketing", "churn_labels")


def star(tables: Mapping[str, DataFrame], names: Sequence[str] = ALL_TABLES) -> DataFrame:
    """Inner join of the named tables. Bucketed tables join without a shuffle.

    Every table has all customers, so none is sent to the driver to be broadcast, however small its files.
    """
    return reduce(lambda left, right: left.join(right.hint("merge"), KEY, "inner"), [tables[name] for name in names])
