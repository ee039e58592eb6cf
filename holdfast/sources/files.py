"""File readers and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class MissingInput(FileNotFoundError):
    """An input is absent; names the stage that makes it."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a stated schema; blanks inside text are kept."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_required(spark: SparkSession, path: str, made_by: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet (or CSV when a schema is given); a missing path names its maker."""
    try:
        return spark.read.parquet(path) if schema is None else read_csv(spark, path, schema)
    except AnalysisException as error:
        if _is_missing(error):
            raise MissingInput(f"{path} not found; run {made_by} first") from error
        raise


def first_available(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The first CSV of an ordered list that can be read and has rows.

    A source that is missing, has another header or cannot be read is passed over,
    and so is an empty one. The first row of each candidate is read at once.
    """
    failures = []
    for path in paths:
        try:
            rows = read_csv(spark, path, schema)
            if not rows.isEmpty():
                return rows
            failures.append(f"{path} has no rows")
        except (AnalysisException, Py4JJavaError, CapturedException) as error:
            failures.append(f"{path}: {str(error).splitlines()[0]}")
    raise MissingInput(f"none of these can be used: {'; '.join(failures)}")


def write_csv(df: DataFrame, path: str) -> None:
    """Full-size CSV, one file per partition; replaces what was there."""
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report of a few rows as one CSV file."""
    write_csv(df.coalesce(1), path)


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([name for name in wanted if name in df.columns])
