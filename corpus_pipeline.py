"""The corpus pipeline: toxicity, line dedup, near-duplicate documents, benchmark overlaps, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last keep the
columns of ``documents``. A stage decides on all rows its predecessor kept.
Nulls, empty tables and repeated rows are handled as the operators define.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import collected_folders, new_folder, remove_folders, row_key, stored
from llm.decontaminate import benchmark_overlaps
from llm.jaccard import one_of_each
from llm.lines import dedup_lines
from llm.packing import pack_documents
from llm.tokens import word_bpe_path
from llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: What a task holds at once while it reads texts and hands them to Python: bounded by bytes, however long the rows are.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}

_earlier: list[str] = []


def _stage(function: Stage) -> Stage:
    """What a stage has stored on the way goes when the next one begins, whose documents are written by then.

    The session keeps ``BATCHES``, for stages are written after they return.
    """

    @wraps(function)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_folders(spark, _earlier)
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        with collected_folders() as mine:
            result = function(spark, docs, sf_dir)
        _earlier[:] = mine
        return result

    return call


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the operator's threshold go."""
    return without_toxic(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; so do documents that lose all they had. Characters are counted anew."""
    kept = dedup_lines(docs.select(COLUMNS)).filter((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words are alike by 0.8 stays."""
    return one_of_each(docs.select(COLUMNS), width=5, percent=80).select(COLUMNS)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go; others with the same id, or without one, stay."""
    found = benchmark_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = stored(found.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct(), "found")
    rows = docs.select(COLUMNS).withColumn("__own", row_key(F.col("doc_id").cast("long"), "text"))
    same = (F.col("__own") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return rows.join(found, same, "left_anti").select(COLUMNS)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in sequences of 2048 tokens."""
    return pack_documents(docs, word_bpe_path(), capacity=2048, separator=0)


STAGES = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("packing", packing),
]

#: SQL can express neither the fitted classifier nor the tokenizer: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the packing of what is left."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        made, path = stage(spark, docs, sf_dir), new_folder(spark, name)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        remove_folders(spark, before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
