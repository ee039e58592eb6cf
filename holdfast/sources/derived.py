"""Customer table derived from ``customer`` and ``orders`` by plain SQL.

The expressions use integers so any SQL engine gives the same bits. Each level
reads the one before it; ``levels()`` is shared by the Spark side and by SQL
checks run elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Expressions per level, output column first.
HISTORY = {
    "o_custkey": "o_custkey",
    "n_orders": "COUNT(*)",
    "n_recent": "SUM(CASE WHEN o_orderdate >= TIMESTAMP '2001-02-01 00:00:00' THEN 1 ELSE 0 END)",
    "n_prio": "SUM(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END)",
    "cents": "SUM(CAST(ROUND(o_totalprice*100) AS BIGINT))",
}
OFFER = {
    "marketing_offer_given": (
        "CASE WHEN n_orders < 10 AND cents % 5 < 3 THEN 1 WHEN n_orders >= 10 AND cents % 5 = 0 THEN 1 ELSE 0 END"
    ),
}


def _add_on(offset: int, modulus: int, below: int) -> str:
    return (
        "CASE WHEN c_nationkey % 3 = 2 THEN 'No internet service' "
        f"WHEN (c_custkey + {offset}) % {modulus} < {below} THEN 'Yes' ELSE 'No' END"
    )


PROFILE = {
    "customer_id": "c_custkey",
    "gender": "CASE WHEN c_nationkey % 2 = 0 THEN 'Male' ELSE 'Female' END",
    "senior_citizen": "CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END",
    "partner": "CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "dependents": "CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END",
    "tenure_months": "CAST(LEAST(72, GREATEST(0, 5*(n_orders-2))) AS INT)",
    "contract_type": (
        "CASE WHEN n_prio*2 >= n_orders THEN 'Month-to-month' "
        "WHEN n_prio*3 >= n_orders THEN 'One year' ELSE 'Two year' END"
    ),
    "phone_service": "CASE WHEN c_custkey % 10 = 0 THEN 'No' ELSE 'Yes' END",
    "multiple_lines": (
        "CASE WHEN c_custkey % 10 = 0 THEN 'No phone service' WHEN c_custkey % 4 < 2 THEN 'Yes' ELSE 'No' END"
    ),
    "internet_service": "CASE c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END",
    "online_security": _add_on(1, 3, 1),
    "online_backup": _add_on(2, 4, 2),
    "device_protection": _add_on(3, 5, 2),
    "tech_support": _add_on(4, 7, 2),
    "streaming_tv": _add_on(5, 8, 3),
    "streaming_movies": _add_on(6, 9, 4),
    "payment_method": (
        "CASE cents % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' "
        "WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END"
    ),
    "paperless_billing": "CASE WHEN cents % 11 < 6 THEN 'Yes' ELSE 'No' END",
    "monthly_cents": "1800 + cents % 10000",
    "marketing_offer_given": "marketing_offer_given",
    "churn_binary": (
        "CASE WHEN marketing_offer_given = 1 AND c_nationkey % 3 = 1 AND cents % 7 < 4 THEN 0 "
        "WHEN marketing_offer_given = 1 AND c_nationkey % 3 = 2 AND cents % 7 < 2 THEN 1 "
        "WHEN n_recent = 0 THEN 1 ELSE 0 END"
    ),
}
MONEY = {
    "monthly_charges": "CAST(monthly_cents AS DOUBLE)/100",
    "total_charges": "CAST(monthly_cents * tenure_months AS DOUBLE)/100",
    "customer_lifetime_value": (
        "ROUND(CAST(monthly_cents AS DOUBLE)/100 * (CASE contract_type WHEN 'Month-to-month' THEN 6 "
        "WHEN 'One year' THEN 14 ELSE 26 END + 3*LN(1+tenure_months)), 2)"
    ),
    "propensity_score": (
        "LEAST(CAST(0.95 AS DOUBLE), GREATEST(CAST(0.05 AS DOUBLE), CAST((CASE WHEN tenure_months < 24 THEN 3 ELSE 0 END "
        "+ CASE WHEN monthly_cents > 7000 THEN 2 ELSE 0 END "
        "+ CASE WHEN contract_type = 'Month-to-month' THEN 3 ELSE 0 END) AS DOUBLE)/10))"
    ),
    "churn_label": "CASE WHEN churn_binary = 1 THEN 'Yes' ELSE 'No' END",
}


def _columns(level: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in level.items())


def levels() -> list[tuple[str, str]]:
    """Named SELECTs, in the order they build on each other; the last is ``flat``."""
    return [
        ("o", f"SELECT {_columns(HISTORY)} FROM orders GROUP BY o_custkey"),
        ("t", f"SELECT *, {_columns(OFFER)} FROM o"),
        ("b", f"SELECT {_columns(PROFILE)} FROM customer JOIN t ON c_custkey = o_custkey"),
        ("flat", f"SELECT *, {_columns(MONEY)} FROM b"),
    ]


def flat_customers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with orders, in table column names.

    Orders are pre-aggregated before the shuffle, and the join reuses their
    partitioning by customer.
    """
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in ("orders", "customer")}
    chain = ", ".join(f"{name} AS ({text})" for name, text in levels())
    for name in tables:
        chain = chain.replace(f"FROM {name} ", f"FROM {{{name}}} ")
    return spark.sql(f"WITH {chain} SELECT * FROM flat", **tables).drop("monthly_cents")
