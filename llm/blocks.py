"""Grouping by hash in blocks: entries travel as packed arrays, one row per task and bucket.

For steps that count or match hundreds of millions of small entries, a row per
entry costs far more than the entry. Here a task packs what it has for a bucket
of hash space into one binary value; Spark shuffles and sorts those rows by bucket;
the receiving task unpacks one bucket at a time. Equal hashes always meet in one
bucket, and callers reduce entries of one hash before sending where they can, so a
frequent hash costs each task one entry.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import as_batch

PACKED = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])
PACKED_DDL = "bucket long, data binary"
#: Entries that a task gathers before it sends them.
HELD = 1_000_000
#: Bytes of text that are scanned at a time, unless one text has more.
BLOCK = 1 << 19
#: Bytes in one batch of packed rows, about: Spark holds a batch outside its heap.
SENT = 1 << 22


def bucket_count(df: DataFrame, per_partition: int = 4) -> int:
    """Buckets in proportion to the input's partitions, so that a bucket stays as small as the input splits."""
    return max(8, per_partition * df.rdd.getNumPartitions())


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def bucket_order(bucket: np.ndarray) -> np.ndarray:
    """Stable order by bucket; numbers of 16 bits are sorted by counting."""
    small = len(bucket) and -(1 << 15) <= bucket.min() and bucket.max() < 1 << 15
    return np.argsort(bucket.astype(np.int16) if small else bucket, kind="stable")


def hash_order(hashes: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """Order by hash (unsigned 64 bits, well spread), then by the others, the last one first, as in ``np.lexsort``.

    Two rounds over 16 bits sort by the upper half of the hashes; only those that share it are compared in full.
    """
    order = np.argsort((hashes >> np.uint64(32)).astype(np.uint16), kind="stable")
    order = order[np.argsort((hashes >> np.uint64(48)).astype(np.uint16)[order], kind="stable")]
    shared = shared_with_next((hashes >> np.uint64(32))[order])
    some = order[shared]
    order[shared] = some[np.lexsort([*(x[some] for x in then), hashes[some]])]
    return order


def shared_with_next(sorted_values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    out = np.zeros(len(sorted_values), bool)
    same = sorted_values[1:] == sorted_values[:-1]
    out[1:] = same
    out[:-1] |= same
    return out


def packed(entries: Iterator[np.ndarray], buckets: int, combine: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    """Rows for the shuffle from structured arrays whose field ``h`` is the hash (unsigned 64 bits)."""
    held: list[np.ndarray] = []
    size = 0

    def send() -> Iterator[pa.RecordBatch]:
        every = np.concatenate(held)
        held.clear()
        if combine is not None:
            every = combine(every)
        bucket = bucket_of(every["h"], buckets)
        order = bucket_order(bucket)
        every, bucket = every.take(order), bucket[order]
        starts = group_starts(bucket)
        stops = np.append(starts[1:], len(bucket))
        for rows in np.split(np.arange(len(starts)), group_starts(stops * every.itemsize // SENT)[1:]):
            yield as_batch(PACKED, [bucket[starts[rows]], [every[a:b].tobytes() for a, b in zip(starts[rows], stops[rows])]])

    for part in entries:
        if len(part):
            held.append(part)
            size += len(part)
            if size >= HELD:
                yield from send()
                size = 0
    if size:
        yield from send()


def gathered(df: DataFrame, buckets: int) -> DataFrame:
    """The rows of each bucket in one partition, one bucket after the other."""
    return df.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def each_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.Buffer]]]:
    """(bucket, its values) for rows that come sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append(data.as_buffer())
    if held:
        yield now, held


def entries_of(values: list[pa.Buffer], kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(v, kind) for v in values])


def each_bucket(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The entries of each bucket, from rows that come sorted by bucket."""
    for _, values in each_group(batches):
        yield entries_of(values, kind)


#: Powers of two between which a table of bits may be sized: eight bits a key within them.
LEAST_BITS, MOST_BITS, PAGE_BITS = 16, 28, 15


def bit_table(keys: DataFrame, column: str) -> np.ndarray:
    """Bits set by the hashes in ``column``, as packed bytes, for ``in_table``.

    A filter that may let more pass but never less. Spark sets the bits; the driver
    gets at most 2^MOST_BITS of them (32 MB), whatever the input. ``keys`` is read twice.
    """
    size = min(MOST_BITS, max(LEAST_BITS, (8 * keys.count()).bit_length()))
    slots = keys.select(F.col(column).bitwiseAND((1 << size) - 1).alias("slot"))
    pages = slots.groupBy(F.shiftright("slot", PAGE_BITS).alias("page")).agg(F.collect_set(F.col("slot").bitwiseAND((1 << PAGE_BITS) - 1).cast("int")).alias("bits"))
    table = np.zeros(1 << (size - 3), np.uint8)
    for row in pages.mapInArrow(_pages, "page long, data binary").collect():
        table[row["page"] << (PAGE_BITS - 3) :][: 1 << (PAGE_BITS - 3)] = np.frombuffer(row["data"], np.uint8)
    return table


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's bits as bytes."""
    schema = pa.schema([("page", pa.int64()), ("data", pa.binary())])
    for batch in batches:
        data = []
        for bits in batch.column("bits"):
            page = np.zeros(1 << PAGE_BITS, np.uint8)
            page[bits.values.to_numpy()] = 1
            data.append(np.packbits(page, bitorder="little").tobytes())
        yield as_batch(schema, [batch.column("page"), data])


def packed_bits(hashes: np.ndarray) -> np.ndarray:
    """The same for hashes at hand, with 256 bits a hash, so that few others pass."""
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (256 * len(hashes)).bit_length()))
    table = np.zeros(size, np.uint8)
    table[hashes & (size - 1)] = 1
    return np.packbits(table, bitorder="little")


def in_table(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (signed 64 bits) have their bit set."""
    slot = hashes & (8 * len(table) - 1)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def maybe_among(keys: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test for columns of hashes: false only if none of ``keys`` has the hash."""
    table = keys.sparkSession.sparkContext.broadcast(bit_table(keys, column))

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_table(table.value, hashes.to_numpy()))

    return test


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of about ``BLOCK`` bytes of text at a time, and their texts (null: empty)."""
    for batch in batches:
        begin, size, texts = 0, 0, []
        for i, text in enumerate(batch.column("text")):
            texts.append(text.as_py() or b"")
            size += len(texts[-1]) + 1
            if size >= BLOCK or i == batch.num_rows - 1:
                yield batch.slice(begin, i + 1 - begin), texts
                begin, size, texts = i + 1, 0, []


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
