"""Data-quality checks. Each gives rows (check, n_bad, passed); ``require`` raises on a failure."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.star import KEY, star
from holdfast.schemas import TABLES


class CheckFailed(ValueError):
    """At least one data-quality check did not pass."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def in_set(name: str, allowed: Sequence[object]) -> Column:
    """True where the value breaks the rule; null breaks it."""
    return ~F.coalesce(F.col(name).isin(list(allowed)), F.lit(False))


def in_range(name: str, low: float | None = None, high: float | None = None, open_low: bool = False) -> Column:
    """True where the value is null or outside the range; ``open_low`` excludes the low end."""
    value, inside = F.col(name), F.lit(True)
    if low is not None:
        inside = inside & (value > low if open_low else value >= low)
    if high is not None:
        inside = inside & (value <= high)
    return ~F.coalesce(inside, F.lit(False))


def not_null(name: str) -> Column:
    return F.col(name).isNull()


def _as_rows(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    lines = [F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").alias("n_bad")) for i, name in enumerate(names)]
    return counts.select(F.inline(F.array(*lines))).withColumn("passed", F.col("n_bad") == 0)


def row_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All row-level rules of a table in one aggregation."""
    counts = df.agg(*[F.count_if(bad).alias(f"_c{i}") for i, bad in enumerate(rules.values())])
    return _as_rows(counts, list(rules))


def unique_key(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Rows beyond the first per key. Keys are counted before and after the shuffle,
    so a key with very many copies stays cheap."""
    extra = df.groupBy(key).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_c0")
    )
    return _as_rows(extra, [name or f"{key} unique"])


def foreign_key(child: DataFrame, parent: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Child rows whose key the parent lacks; a null key counts as lacking."""
    orphans = child.select(key).join(parent.select(key), key, "left_anti")
    return _as_rows(orphans.agg(F.count("*").alias("_c0")), [name or f"{key} known"])


def null_total(df: DataFrame) -> DataFrame:
    """Nulls over all columns, in one aggregation."""
    total = reduce(lambda a, b: a + b, [F.count_if(F.col(name).isNull()) for name in df.columns])
    return df.agg(total.alias("n_nulls"))


def join_is_complete(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The five-way join has exactly one row per customer."""
    joined = star({name: table.select(KEY) for name, table in tables.items()}).agg(F.count("*").alias("n_joined"))
    customers = tables["customers"].agg(F.count("*").alias("n")).scalar()
    return joined.select("n_joined", customers.alias("n_customers")).withColumn(
        "passed", F.col("n_joined") == F.col("n_customers")
    )


def is_non_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


def table_rules(name: str) -> dict[str, Column]:
    """Row rules of one of the five tables: no nulls, flags in {0,1}, ranges."""
    # Limits stated for the five tables.
    limits = {
        "customers": {
            "tenure_months >= 0": in_range("tenure_months", 0),
            "senior_citizen in 0,1": in_set("senior_citizen", [0, 1]),
        },
        "services": {},
        "billing": {
            "monthly_charges >= 0": in_range("monthly_charges", 0),
            "customer_lifetime_value > 0": in_range("customer_lifetime_value", 0, open_low=True),
        },
        "marketing": {
            "marketing_offer_given in 0,1": in_set("marketing_offer_given", [0, 1]),
            "propensity_score in [0,1]": in_range("propensity_score", 0, 1),
        },
        "churn_labels": {"churn_binary in 0,1": in_set("churn_binary", [0, 1])},
    }
    nulls = {f"{field.name} not null": not_null(field.name) for field in TABLES[name]}
    return {**nulls, **limits[name]}


REPORT = "table string, check string, n_bad long, passed boolean"


def watch_rows(table: DataFrame, name: str) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The table with its row rules counted by whatever job reads it, and a function that gives the lines once it has."""
    rules, seen = table_rules(name), Observation()
    watched = table.observe(seen, *[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(rules.values())])

    def lines() -> list[tuple]:
        counts = _counts(seen)
        return [(name, rule, counts.get(f"c{i}") or 0) for i, rule in enumerate(rules)]

    return watched, lines


def _counts(seen: Observation) -> dict:
    """What was observed; nothing where Spark knew that there are no rows and read none."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def key_counts(tables: Mapping[str, DataFrame], customers: DataFrame) -> DataFrame:
    """(table, extra, lost): rows beyond the first of a key, and rows whose key no customer has; a null key is nobody's.

    Each table is read once, the key column of ``customers`` once for each other
    table. Tables bucketed alike by the key meet without an exchange of rows.
    """
    known = customers.select(KEY).distinct().withColumn("_known", F.lit(True))
    reports = []
    for name, table in tables.items():
        keys = table.groupBy(KEY).agg(F.count("*").alias("_n"))
        lost = F.lit(0)
        if name != "customers":
            keys, lost = keys.join(known, KEY, "left"), F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0)
        sums = {"extra": F.col("_n") - 1, "lost": lost}
        reports.append(keys.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(n) for n, x in sums.items()]).select(F.lit(name).alias("table"), *sums))
    return reduce(DataFrame.union, reports)


def key_lines(tables: Mapping[str, DataFrame], customers: DataFrame) -> list[tuple]:
    """Lines on copies of keys and on keys that no customer has."""
    lines = []
    for name, extra, lost in key_counts(tables, customers).collect():
        lines.append((name, f"{KEY} unique", extra))
        if name != "customers":
            lines.append((name, f"{KEY} known", lost))
    return lines


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, check, n_bad, passed) for every rule of the five tables.

    Eager: one job groups the keys of every table, and row rules are counted by its scans as the rows pass.
    """
    watched = {name: watch_rows(table, name) for name, table in tables.items()}
    keys = key_lines({name: table for name, (table, _) in watched.items()}, tables["customers"])
    return report_of(next(iter(tables.values())).sparkSession, [line for _, lines in watched.values() for line in lines()] + keys)


def report_of(spark: SparkSession, lines: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(*line, line[2] == 0) for line in lines], REPORT)


def require(report: DataFrame) -> None:
    """Raise with the failed checks of a report, which has one row per rule."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{row['check']}: {row['n_bad']} bad" for row in failed))
