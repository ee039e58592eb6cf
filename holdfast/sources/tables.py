"""The five customer tables: split, storage layout, reading back, catalog."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.schemas import SNAKE_CASE, TABLES
from holdfast.session import together
from holdfast.sources import published

KEY = "customer_id"


def snake_case(df: DataFrame) -> DataFrame:
    """Export column names to table column names."""
    return df.withColumnsRenamed(SNAKE_CASE)


def split_tables(flat: DataFrame) -> dict[str, DataFrame]:
    """The flat customer rows as five tables. The key keeps its own type."""
    parts = {}
    for name, schema in TABLES.items():
        parts[name] = flat.select(
            [F.col(f.name) if f.name == KEY else F.col(f.name).cast(f.dataType) for f in schema]
        )
    return parts


def write_tables(tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite") -> int:
    """Publish tables as Parquet in one step; ``append`` adds rows, and other tables of the folder stay.

    Readers see all the new tables or, should one fail, all the old ones. Gives the
    number of the set, under which ``read_table`` finds it until it is cleaned away.
    """
    if mode not in {"overwrite", "append"}:
        raise ValueError(f"mode is overwrite or append, not {mode}")
    spark = next(iter(tables.values())).sparkSession
    return published.publish_rows(spark, folder, tables, append=mode == "append")


def read_table(spark: SparkSession, folder: str, name: str, version: int | None = None) -> DataFrame:
    return published.read_rows(spark, folder, name, "write_tables", version)


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All five tables of one and the same set."""
    known = published.versions(spark, folder)
    return {name: read_table(spark, folder, name, known[-1] if known else None) for name in TABLES}


def bucket_count(spark: SparkSession, rows: int, rows_per_bucket: int = 2_000_000) -> int:
    """Buckets for a table: at least one per core, else by row count.

    2,000,000 customers are some 150 MB in the widest of the five tables.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_bucket))


def save_bucketed(flat: DataFrame, folder: str, prefix: str, buckets: int) -> dict[str, DataFrame]:
    """The five tables in the catalog, all bucketed by customer_id.

    One shuffle puts the flat rows in place. The five writes and every later
    join between the tables then need none.
    """
    spark = flat.sparkSession

    def save(df: DataFrame, name: str) -> DataFrame:
        (
            df.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
            .option("path", f"{folder}/{name}").saveAsTable(f"{prefix}{name}")
        )
        return spark.table(f"{prefix}{name}")

    placed = save(flat.repartition(buckets, KEY), "flat")
    parts = split_tables(placed)
    saved = together(spark, *[partial(save, part, name) for name, part in parts.items()])
    return dict(zip(parts, saved))


def saved_tables(spark: SparkSession, prefix: str) -> dict[str, DataFrame] | None:
    """Tables written by ``save_bucketed`` in this session, or None."""
    if not all(spark.catalog.tableExists(f"{prefix}{name}") for name in TABLES):
        return None
    return {name: spark.table(f"{prefix}{name}") for name in TABLES}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Temp views, for SQL text over the tables."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_rows), one count per table."""
    counts = [t.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def catalog_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, n_rows) for every column of every table."""
    reports = []
    for name, table in tables.items():
        listed = F.array(
            *[
                F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
                for i, f in enumerate(table.schema, start=1)
            ]
        )
        reports.append(
            table.agg(F.count("*").alias("n_rows"))
            .select(F.lit(name).alias("table"), "n_rows", F.inline(listed))
            .select("table", "position", "column", "type", "n_rows")
        )
    return reduce(DataFrame.unionByName, reports)
