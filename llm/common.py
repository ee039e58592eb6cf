"""Shared folder, row keys, words and word hashes for the operators of this package."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words that one Python worker remembers the hash of; beyond it, it starts afresh. Workers outlive tasks, so this is memory that stays.
REMEMBERED = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; one is made only where that is unset."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_collectors: list[list[str]] = []


@contextmanager
def collected_folders() -> Iterator[list[str]]:
    """The folders that are made inside the block, for whoever removes them once they are no longer read."""
    mine: list[str] = []
    _collectors.append(mine)
    try:
        yield mine
    finally:
        _collectors.remove(mine)


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place, files = _place(spark, path)
        files.delete(place, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that the driver's JVM removes when it ends, if nobody has before."""
    path = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"
    place, files = _place(spark, path)
    files.deleteOnExit(place)
    for collector in _collectors:
        collector.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it from there: lost executors cost no recomputing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*columns: str | Column) -> Column:
    """A number that equal rows share. With the id beside it, it tells rows apart that repeat an id."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in columns])


class WordHash(dict):
    """Hash of a word (bytes) as an int below 2^63, remembered for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word) >> 1
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One per Python worker, which serves many tasks.
WORDS = WordHash()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


ODD = np.uint64(0x9E3779B97F4A7C15)


#: What is left of eight bytes read at the start of a word of so many bytes.
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of a word that are hashed with those of the other words at once.
TOGETHER = 64


def word_edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and where they stop, for all of a block of texts at once."""
    b = np.frombuffer(data, np.uint8)
    word = np.zeros(len(b) + 2, bool)
    word[1:-1] = (b - np.uint8(9) > 4) & (b != 32)
    at = np.flatnonzero(word[1:] != word[:-1])
    return at[0::2], at[1::2]


def word_hashes(data: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each word of a block, from eight bytes at a time; the rest of very long words is hashed one by one."""
    eight = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    size = stops - starts
    out = mixed(eight[starts] & FIRST_BYTES[np.minimum(size, 8)]) + size.astype(np.uint64) * ODD
    at, more = 8, np.flatnonzero(size > 8)
    while len(more) and at < TOGETHER:
        out[more] = mixed(out[more] ^ eight[starts[more] + at] & FIRST_BYTES[np.minimum(size[more] - at, 8)])
        at += 8
        more = more[size[more] > at]
    for k in more.tolist():
        out[k : k + 1] = mixed(out[k : k + 1] ^ np.uint64(xxhash.xxh3_64_intdigest(data[starts[k] + at : stops[k]])))
    return out


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, in order; none if there are fewer."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, width):
        out = out * ODD + words[k : k + n]
    return mixed(out)


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def as_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def rows_in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``most``."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield as_batch(schema, list(zip(*held)))
            held = []
    if held:
        yield as_batch(schema, list(zip(*held)))
