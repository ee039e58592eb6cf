"""Session settings, the shared folder, and lineage cuts."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Recording the Python line of every column expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "holdfast", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the plans assume; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    On a cluster the setting is required. A local master without it, as in tests,
    gets a temporary folder, which its one machine shares with itself.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="holdfast-")
    if current is None:
        context.setCheckpointDir(configured)
    return configured or current


def settle(df: DataFrame) -> DataFrame:
    """Compute a small ``df`` once into the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. It is removed by ``owned_scratch`` or, at the latest, when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/holdfast-{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"
    place, files = _place(spark, path)
    files.deleteOnExit(place)
    for owner in _owners:
        owner.append(path)
    return path


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_owners: list[list[str]] = []


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Own what is stored inside the block, and remove it at its end: write the results within."""
    mine: list[str] = []
    _owners.append(mine)
    try:
        yield mine
    finally:
        _owners.remove(mine)
        for path in mine:
            place, files = _place(spark, path)
            files.delete(place, True)


def store(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a Parquet folder of this application and read from there.

    For rows that several jobs read: each reads only its columns, and lost
    executors change nothing.
    """
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], object], at_once: int | None = None) -> list:
    """Run independent jobs from driver threads, all or ``at_once`` at a time, so their stages share the cluster."""
    pool = ThreadPool(min(len(jobs), at_once or len(jobs)))
    try:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs], chunksize=1)
    finally:
        pool.close()
