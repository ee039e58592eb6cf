"""Exact Lloyd clustering of whole-number vectors, sharded by columns.

Vectors are cut into blocks of rows and shards of columns; a slice, one block of one
shard, is the unit of work, however wide the vectors are. Slices are written once and dealt
out by (shard, block). In each round a slice gives the exact partial distances to its shard's part of the
centroids; ``reduceByKey`` adds the partial distances of a block and takes the nearest.
The labels, one small number a vector, go back to the shards, which keep their slices
in place, and every shard sums its own columns and updates its own part.

All numbers are whole and exact: in doubles where sums stay below 2^53, else in
64 bits, else in Python's numbers. Distances of 2^63 and more are given as 2^63 - 1.

Defined cases: vectors that are null, of another length, or hold null or
non-finite numbers take no part; a null id takes part, hashed as an empty number; repeated rows are
vectors each, and of equal ids the smaller vector starts first; of equally near centroids the first is
taken; a centroid without vectors stays; fewer vectors than centroids make fewer
centroids; no vectors give no rows. Other columns are ignored.

The driver holds the centroids (k times the dimension, at most ``MOST_CELLS``) and
one sum for each, nothing that grows with the rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import as_batch, stored

#: Rows of a block; columns of a shard; slices of a partition.
BLOCK, WIDTH, SLICES = 2048, 32, 64
#: Numbers that the centroids may have together.
MOST_CELLS = 1 << 22
LONGEST = (1 << 63) - 1
SLICE = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
FOUND = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as hold them."""
    if x.dtype == object:
        if any(abs(v) >= 1 << 62 for v in x.flat):
            return x
        x = x.astype(np.int64)
    top = np.abs(x).max(initial=0)
    return x.astype(next((kind for kind, bits in ((np.int16, 15), (np.int32, 31)) if top < 1 << bits), np.int64))


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); numbers that doubles hold but 64 bits do not are Python's."""
    with np.errstate(over="ignore"):
        cells = np.floor(x * scale)
    if np.abs(cells).max(initial=0) < 1 << 62:
        return _narrow(cells.astype(np.int64))
    exact = np.array([int(v * scale // 1) if abs(v) < 2.0**900 else int(v) * scale for v in x.flat], object)
    return _narrow(exact.reshape(x.shape))


def _top(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0)) if x.dtype != object else max((abs(v) for v in x.flat), default=0)


def partial_distances(x: np.ndarray, centroids: np.ndarray, shards: int) -> np.ndarray:
    """Squared distances of rows to rows over these columns, exact; ``shards`` of them can be added."""
    most = (2 * max(_top(x), _top(centroids))) ** 2 * max(1, x.shape[1])
    if most < 1 << 52:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return _narrow(((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64))
    kind = np.int64 if most * shards < 1 << 62 else object
    a, b = x.astype(kind), centroids.astype(kind)
    total = np.zeros((len(a), len(b)), kind)
    for column in range(a.shape[1]):
        total += (a[:, column, None] - b[None, :, column]) ** 2
    return total


def label_sums(x: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """The sum of the rows of each label, exact."""
    most = _top(x) * max(1, len(x))
    if most < 1 << 52:
        members = np.zeros((k, len(x)))
        members[labels, np.arange(len(x))] = 1
        return (members @ x.astype(np.float64)).astype(np.int64)
    sums = np.zeros((k, x.shape[1]), np.int64 if most < 1 << 62 else object)
    np.add.at(sums, labels, x.astype(sums.dtype))
    return sums


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum in 64 bits, or in Python's numbers where it might not fit."""
    a, b = (v if v.dtype == object else v.astype(np.int64) for v in (a, b))
    if a.dtype != object and b.dtype != object and _top(a) + _top(b) >= 1 << 62:
        a = a.astype(object)
    return a + b


def _slicer(scale: int, dim: int, width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of rows, numbered in each task, cut into shards of columns; the first shard carries the ids."""
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids = part.column("vec_id")
                known = (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
                cells = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                block, made = task * (1 << 32) + made, made + 1
                for shard, left in enumerate(range(0, dim, width)):
                    data = (None if shard else known, whole_numbers(cells[:, left : left + width], scale))
                    yield as_batch(SLICE, [[shard], [block], [pickle.dumps(data, 5)]])

    return cut


def _assigned(slices: RDD, centroids: list[np.ndarray], parts: int) -> RDD:
    """(block, (ids, partial distances added over all shards))."""
    shards = len(centroids)

    def partial(item: tuple) -> tuple:
        (shard, block), (ids, cells) = item
        return block, (ids, partial_distances(cells, centroids[shard], shards))

    return slices.map(partial).reduceByKey(lambda a, b: (a[0] or b[0], plus(a[1], b[1])), parts)


def _updated(slices: RDD, centroids: list[np.ndarray], parts: int) -> list[np.ndarray]:
    """One round: the parts of the new centroids, each made by its own shard."""
    shards, k = len(centroids), len(centroids[0])
    labels = _assigned(slices, centroids, parts).mapValues(lambda v: v[1].argmin(axis=1).astype(np.int32))
    dealt = labels.flatMap(lambda item: [((shard, item[0]), item[1]) for shard in range(shards)]).partitionBy(parts)

    def sums(item: tuple) -> tuple:
        (shard, _), ((_, cells), own) = item
        return shard, (label_sums(cells, own, k), np.bincount(own, minlength=k))

    def moved(item: tuple) -> tuple:
        shard, (total, count) = item
        new = total // np.maximum(count, 1)[:, None]
        new[count == 0] = centroids[shard][count == 0]
        return shard, _narrow(new)

    added = slices.join(dealt, parts).map(sums).reduceByKey(lambda a, b: (plus(a[0], b[0]), a[1] + b[1]), shards)
    made = added.map(moved).collectAsMap()
    return [made[shard] for shard in range(shards)]


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data"):
            (values, missing), labels, distances = pickle.loads(data.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64(), mask=missing), pa.array(labels), pa.array(distances)], schema=FOUND)


def _nearest(item: tuple) -> tuple:
    ids, distances = item[1]
    labels = distances.argmin(axis=1)
    own = np.array([min(int(v), LONGEST) for v in distances[np.arange(len(labels)), labels]], np.int64)
    return (bytearray(pickle.dumps((ids, labels.astype(np.int32), own), 5)),)


def lloyd(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dim: int = 64, seed: int = 2, width: int = WIDTH) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dim`` numbers.

    The first centroids are the ``k`` vectors whose ids, with ``seed``, have the
    smallest hashes. Runs a job a round; the result is read from what the last one stored.
    """
    if k * dim > MOST_CELLS:
        raise ValueError(f"centroids may have {MOST_CELLS} numbers together")
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.filter((F.size("x") == dim) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(digest, "x").limit(k).select("x").collect()
    found = "vec_id long, cluster int, distance long"
    if not first:
        return spark.createDataFrame([], f"{found}, cluster_inertia long, inertia long, centroid_sha256 string")
    start = whole_numbers(np.array([r["x"] for r in first]), scale)
    centroids = [start[:, left : left + width] for left in range(0, dim, width)]

    kept = stored(rows.mapInArrow(_slicer(scale, dim, width), "shard int, block long, data binary"), "slices")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-kept.count() // SLICES))
    slices = kept.rdd.map(lambda r: ((r["shard"], r["block"]), pickle.loads(r["data"]))).partitionBy(parts)
    for _ in range(rounds):
        centroids = _updated(slices, centroids, parts)
    last = spark.createDataFrame(_assigned(slices, centroids, parts).map(_nearest), "data binary")
    result = stored(last.mapInArrow(_unpacked, found), "clusters")

    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {r["cluster"]: int(r["total"]) for r in result.groupBy("cluster").agg(total).collect()}
    every = min(sum(sums.values()), LONGEST)
    joined = np.concatenate(centroids, axis=1).tolist()
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in joined]
    about = [(c, min(s, LONGEST), every, digests[c]) for c, s in sorted(sums.items())]
    return result.join(F.broadcast(spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
