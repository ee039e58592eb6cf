"""Five tables for a folder of source tables, written once per session and folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.plans.retention import modeling_dataset
from holdfast.session import shared_folder
from holdfast.sources.derived import flat_customers
from holdfast.sources.tables import bucket_count, save_bucketed, saved_tables


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Derive the customers of ``sf_dir`` and save them as bucketed tables."""
    app = spark.sparkContext.applicationId
    digest = hashlib.sha1(f"{app}|{sf_dir}".encode()).hexdigest()[:12]
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    folder = f"{shared_folder(spark)}/tables-{digest}"
    return save_bucketed(flat_customers(spark, sf_dir), folder, _prefix(spark, sf_dir), bucket_count(spark, rows))


def _prefix(spark: SparkSession, sf_dir: str) -> str:
    """Of this application's tables: a lasting catalog may hold those of earlier ones."""
    name = f"{spark.sparkContext.applicationId}|{sf_dir}"
    return f"holdfast_{hashlib.sha1(name.encode()).hexdigest()[:10]}_"


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The saved tables of this session; source folders do not change within one."""
    return saved_tables(spark, _prefix(spark, sf_dir)) or load_tables(spark, sf_dir)


def modeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling_dataset(tables(spark, sf_dir))


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers before the split, as saved."""
    tables(spark, sf_dir)
    return spark.table(f"{_prefix(spark, sf_dir)}flat")


# Broken rows: (table, column, remainder of customer_id by 101, value). Every rule of the tables is broken somewhere.
MODULUS = 101
BROKEN_VALUES = [
    ("customers", "tenure_months", 50, -1), ("customers", "senior_citizen", 51, 7), ("billing", "monthly_charges", 52, -5.0),
    ("billing", "customer_lifetime_value", 53, 0.0), ("marketing", "marketing_offer_given", 54, 2),
    ("marketing", "propensity_score", 55, 1.5), ("churn_labels", "churn_binary", 56, 3),
]
COPIED, ORPHANED, ABROAD = (97, 1), (89, 2), 10_000_000


def dirty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables with nulls in every column, values out of range, copied keys and keys that no customer has."""
    out = {}
    key = F.col("customer_id")
    for name, table in tables(spark, sf_dir).items():
        copies = table.where(key % COPIED[0] == COPIED[1])
        orphans = table.where(key % ORPHANED[0] == ORPHANED[1]).withColumn("customer_id", key + ABROAD)
        broken = {c: F.when(key % MODULUS == i, F.lit(None)).otherwise(F.col(c)) for i, c in enumerate(table.columns)}
        for where, column, remainder, value in BROKEN_VALUES:
            if where == name:
                kind = table.schema[column].dataType
                broken[column] = F.when(key % MODULUS == remainder, F.lit(value).cast(kind)).otherwise(broken[column])
        rows = table.select([broken[c].alias(c) for c in table.columns]).union(copies)
        out[name] = rows if name == "customers" else rows.union(orphans)
    return out
