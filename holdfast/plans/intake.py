"""From a customer export to rows ready for the five tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import customer
from holdfast.functions.numeric import fixed, lenient_number, yes_flag
from holdfast.operators.checks import CheckFailed, in_range, in_set, key_lines, missing_columns, report_of, require, row_checks, unique_key, watch_rows
from holdfast.operators.quantiles import percentiles
from holdfast.schemas import SNAKE_CASE
from holdfast.sources import published
from holdfast.sources import tables as layout


def clean(raw: DataFrame) -> DataFrame:
    """Total charges as a number, 0.0 where blank, and churn as 0 or 1."""
    return raw.withColumns(
        {
            "TotalCharges": F.coalesce(lenient_number(F.col("TotalCharges")), F.lit(0.0)),
            "Churn_Binary": yes_flag(F.col("Churn")),
        }
    )


def enrich(cleaned: DataFrame, propensity: Column | None = None, offer: Column | None = None, seed: int = 42) -> DataFrame:
    """Add propensity, offer flag and lifetime value, by row.

    Without a propensity, the rule-based one is used, which leaves the outcome
    out. Without an offer flag, offers are drawn with the propensity by a hash of
    the key.
    """
    tenure, monthly, contract = F.col("tenure"), F.col("MonthlyCharges"), F.col("Contract")
    score = customer.risk_score(tenure, monthly, contract) if propensity is None else propensity
    scored = cleaned.withColumn("Propensity_Score", fixed(score, 4))
    drawn = customer.hashed_assignment(F.col("customerID"), F.col("Propensity_Score"), seed) if offer is None else offer
    return scored.withColumns(
        {
            "Marketing_Offer_Given": drawn,
            "Customer_Lifetime_Value": fixed(customer.lifetime_value(monthly, tenure, contract), 2),
        }
    )


def check_enriched(enriched: DataFrame) -> DataFrame:
    """(check, n_bad, passed) for an enriched export; raises if a column is missing."""
    absent = missing_columns(enriched, SNAKE_CASE)
    if absent:
        raise CheckFailed(f"missing columns: {', '.join(absent)}")
    rules: Mapping[str, Column] = {
        "Churn_Binary in 0,1": in_set("Churn_Binary", [0, 1]),
        "Marketing_Offer_Given in 0,1": in_set("Marketing_Offer_Given", [0, 1]),
        "Propensity_Score in [0,1]": in_range("Propensity_Score", 0, 1),
        "Customer_Lifetime_Value > 0": in_range("Customer_Lifetime_Value", 0, open_low=True),
    }
    return row_checks(enriched, rules).unionByName(unique_key(enriched, "customerID"))


def five_tables(enriched: DataFrame) -> dict[str, DataFrame]:
    """The enriched export as the five tables."""
    return layout.split_tables(layout.snake_case(enriched))


def load_checked(tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Write the five tables, check them, and publish them in one step; gives the report of ``check_tables``.

    The writing jobs count what breaks a row rule, so no table is read again for
    that; keys are checked over the key columns just written. A rule that fails
    raises, and readers keep what was published before.
    """
    spark = next(iter(tables.values())).sparkSession
    watched = {name: watch_rows(table, name) for name, table in tables.items()}
    made: list[DataFrame] = []

    def check(places: dict[str, str]) -> None:
        written = {name: spark.read.parquet(place) for name, place in places.items()}
        keys = key_lines(written, written["customers"])
        made.append(report_of(spark, [line for _, lines in watched.values() for line in lines()] + keys))
        require(made[0])

    published.publish(spark, folder, {name: table.write.parquet for name, (table, _) in watched.items()}, check=check)
    return made[0]


RISK_SHARE = 0.7


def flag_high_risk(rows: DataFrame, risk: str, key: str, share: float = RISK_SHARE, flag: str = "high_risk") -> DataFrame:
    """Mark the rows whose risk lies above the exact percentile at ``share`` of all risks. Eager: the percentile is found first."""
    limit = percentiles(rows, risk, {"limit": share}, key).scalar()
    return rows.withColumn(flag, customer.high_risk_flag(F.col(risk), limit))
