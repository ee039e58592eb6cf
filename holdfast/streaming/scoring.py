"""Score requests as they arrive.

Every micro-batch writes three outputs, each under a folder named for the batch:
responses, quarantined requests and totals. A batch that is replayed after a
failure overwrites its own folders, so nothing is counted twice.

Totals over all batches are carried from batch to batch in a published snapshot of
one row, which names the batch it ends with. A batch adds to the newest snapshot of an earlier one,
so a replay adds once, and readers open one small file however long the stream has run.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from holdfast.functions.numeric import fixed
from holdfast.functions.segments import SERVING_RISK
from holdfast.plans.scoring import Outcomes, batch_totals, score_requests, with_errors
from holdfast.schemas import REQUEST
from holdfast.sources import published
from holdfast.sources.rescued import parse_json, read_csv

#: Snapshots that stay: a replayed batch finds the one before its own.
SNAPSHOTS = 3
TOTALS = T.StructType([
    T.StructField("total_customers", T.LongType()), T.StructField("total_revenue_at_risk", T.DoubleType()),
    T.StructField("persuadable_count", T.LongType()), T.StructField("persuadable_revenue", T.DoubleType()),
    T.StructField("sleeping_dog_count", T.LongType()),
])


def read_requests(spark: SparkSession, path: str, file_format: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """Requests from files landing in a folder, read without loss: the fields, ``rescued``, and the text as ``raw``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        return read_csv(reader, path, REQUEST)
    if file_format == "json":
        return parse_json(reader.text(path), REQUEST)
    return reader.schema(REQUEST).format(file_format).load(path)


def scored_stream(requests: DataFrame, outcomes: Outcomes, risk_threshold: float = SERVING_RISK) -> DataFrame:
    """Responses to the valid requests, as a stream for any append sink."""
    valid = with_errors(requests).where(F.size("errors") == 0).drop("errors")
    return score_requests(valid, outcomes, risk_threshold)


def start_scoring(
    requests: DataFrame, outcomes: Outcomes, output: str, checkpoint: str,
    risk_threshold: float = SERVING_RISK, available_now: bool = False, interval: str = "1 minute",
) -> StreamingQuery:
    """Run scoring with all three outputs under ``output``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = with_errors(batch).persist(StorageLevel.MEMORY_AND_DISK)
        broken = F.size("errors") > 0
        try:
            folder = f"batch={batch_id}"
            scored_path = f"{output}/scored/{folder}"
            scored = score_requests(checked.where(~broken).drop("errors"), outcomes, risk_threshold)
            scored.write.mode("overwrite").parquet(scored_path)
            checked.where(broken).write.mode("overwrite").parquet(f"{output}/quarantine/{folder}")
            # Totals read the responses just written, so rows are scored once.
            written = batch.sparkSession.read.schema(scored.schema).parquet(scored_path)
            batch_totals(written).coalesce(1).write.mode("overwrite").parquet(f"{output}/totals/{folder}")
            add_to_running(batch.sparkSession, output, batch_id)
        finally:
            checked.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def _exact(field: T.StructField) -> str:
    return "decimal(38,2)" if field.dataType == T.DoubleType() else "bigint"


def _snapshots(spark: SparkSession, output: str, limit: int) -> list:
    """(version, row) of the newest snapshots, newest first."""
    folder = f"{output}/running"
    known = published.versions(spark, folder)[-limit:]
    return [(v, published.read_rows(spark, folder, "running", "start_scoring", v).first()) for v in reversed(known)]


def add_to_running(spark: SparkSession, output: str, batch_id: int) -> None:
    """Publish the totals up to and with a batch, whose own are written; doing it again changes nothing."""
    before = next((row for _, row in _snapshots(spark, output, SNAPSHOTS) if row["batch"] < batch_id), None)
    own = spark.read.schema(TOTALS).parquet(f"{output}/totals/batch={batch_id}")
    added = [
        (F.coalesce(F.sum(F.col(f.name).cast(_exact(f))), F.lit(0)) + F.lit(before[f.name] if before else 0)).cast(_exact(f)).alias(f.name)
        for f in TOTALS
    ]
    snapshot = own.agg(*added).select(F.lit(batch_id).cast("long").alias("batch"), "*").coalesce(1)
    published.publish_rows(spark, f"{output}/running", {"running": snapshot})
    published.clean(spark, f"{output}/running", SNAPSHOTS)


def running_totals(spark: SparkSession, output: str) -> DataFrame:
    """Totals over every batch so far, from the newest snapshot; zeros before the first."""
    newest = _snapshots(spark, output, 1)
    row = [tuple(newest[0][1][f.name] if newest else 0 for f in TOTALS)]
    kept = spark.createDataFrame([tuple(float(v) if f.dataType == T.DoubleType() else int(v) for v, f in zip(row[0], TOTALS))], TOTALS)
    return kept.select(*[fixed(F.col(f.name), 2).alias(f.name) if "revenue" in f.name else F.col(f.name) for f in TOTALS])
