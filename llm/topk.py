"""Exact top-k by inner product, with bounds from segment means and deviations, coarse to fine.

Vectors of whole numbers are cut into equal segments. For two vectors the inner
product of a segment of length L is at most L * (mean * mean' + dev * dev'), so
sums over segments bound the score from above (which bounds the distance from
below), more tightly with more segments. A pair is scored exactly only while
every bound reaches the score that already holds rank k for its query.

Queries and candidates are packed into blocks of bounded size. Each pair of
blocks is one row of a join, so work is spread by pairs and no task holds more
than two blocks. The query set is stated by the caller.

Defined cases: vectors that are null, or hold null or non-finite numbers, take no
part; a null id takes no part; shorter vectors count as padded with zeros; empty
ones score 0. Rows with the id of the query are not its candidates. Ties go to
the smaller id; repeated rows are candidates each. Query rows that share an id are queries
each, with ``k`` ranks of their own, but those that give the same list are one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import rows_in_batches, stored

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: Candidate blocks that meet a query block in one task, one after the other.
IN_TURN = 4
#: Share of pairs under which they are looked at one by one.
FEW = 0.05
LEVELS = (1, 4, 16)
PACKED = "side string, block long, ids binary, width int, cells binary"
PACKED_SCHEMA = pa.schema([("side", pa.string()), ("block", pa.int64()), ("ids", pa.binary()), ("width", pa.int32()), ("cells", pa.binary())])
PAIR_SCHEMA = pa.schema([("q_block", pa.int64()), ("at", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole_vectors(df: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """(vec_id, cells): floor(scale * x) of every component, rows that take part only."""
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(scale)).cast("long")).alias("cells"))


def _packer(query_step: int, query_block: int, candidate_block: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries and of candidates; each task numbers its own."""
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, list] = {"q": [], "c": []}

        def flush(side: str) -> tuple:
            nonlocal made
            rows, held[side] = held[side], []
            dim = max((len(r[1]) for r in rows), default=0)
            cells = np.zeros((len(rows), dim), np.int64)
            for i, r in enumerate(rows):
                cells[i, : len(r[1])] = r[1]
            made += 1
            top = np.abs(cells).max(initial=0)
            width = 2 if 0 <= top < 1 << 15 else 8
            return side, task * (1 << 32) + made, np.array([r[0] for r in rows], np.int64).tobytes(), width, cells.astype(f"i{width}").tobytes()

        def blocks() -> Iterator[tuple]:
            for batch in batches:
                for row in zip(batch.column("vec_id").to_pylist(), batch.column("cells").to_pylist()):
                    held["c"].append(row)
                    if row[0] % query_step == 0:
                        held["q"].append(row)
                    if len(held["c"]) >= candidate_block:
                        yield flush("c")
                    if len(held["q"]) >= query_block:
                        yield flush("q")
            for side in ("c", "q"):
                if held[side]:
                    yield flush(side)

        yield from rows_in_batches(blocks(), PACKED_SCHEMA, 1)

    return pack


def _stats(cells: np.ndarray, parts: int) -> np.ndarray:
    """Per row and segment sqrt(L) * mean and sqrt(L) * deviation, side by side: a product of two is the bound."""
    n, dim = cells.shape
    edges = np.linspace(0, dim, parts + 1).astype(int)
    out = np.zeros((n, 2 * parts))
    for p, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            part = cells[:, a:b].astype(np.float64)
            mean = part.mean(1)
            out[:, p] = mean * np.sqrt(b - a)
            out[:, parts + p] = np.sqrt(((part - mean[:, None]) ** 2).sum(1))
    return out


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; floats are exact while every sum stays below 2^24 or 2^53."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[-1])
    if top < 2**53:
        kind = np.float32 if top < 2**24 else np.float64
        return (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
    return q @ c.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        sure, tied = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        tied = tied[np.argsort(ids[tied], kind="stable")][: k - len(sure)]
        return np.concatenate([sure, tied])
    return np.arange(len(scores))


def _survivors(alive: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Pairs whose bound reaches ``least`` of their query: by one product while many are alive, pair by pair when few are."""
    if alive.mean() > FEW:
        return alive & (left @ right.T >= least[:, None])
    i, j = np.nonzero(alive)
    keep = np.einsum("ij,ij->i", left[i], right[j]) >= least[i]
    out = np.zeros_like(alive)
    out[i[keep], j[keep]] = True
    return out


def top_of_blocks(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, held: list) -> None:
    """Bring ``held``, the best (scores, ids) of each query so far, up to date with one block of candidates."""
    dim = max(q.shape[1], c.shape[1], 1)
    q, c = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (q, c))
    levels = [p for p in LEVELS if p <= dim]
    stats = [(_stats(q, p), _stats(c, p)) for p in levels]
    slack = 1e-9 * np.linalg.norm(q.astype(np.float64), axis=1) * np.linalg.norm(c.astype(np.float64), axis=1).max(initial=0) + 1e-6
    alive = c_ids[None, :] != q_ids[:, None]

    # The best by a middle bound fill the places that are still open, so that every query has a score to reach.
    if any(len(scores) < k for scores, _ in held):
        bound = np.where(alive, stats[len(levels) // 2][0] @ stats[len(levels) // 2][1].T, -np.inf)
        for i, (scores, ids) in enumerate(held):
            if len(scores) < k:
                lead = np.argpartition(bound[i], len(c) - k)[len(c) - k :] if len(c) > k else np.arange(len(c))
                lead = lead[alive[i, lead]]
                held[i] = np.concatenate([scores, _scores(q[i : i + 1], c[lead])[0]]), np.concatenate([ids, c_ids[lead]])
                alive[i, lead] = False
    least = np.array([np.partition(s, len(s) - k)[len(s) - k] if len(s) >= k else -np.inf for s, _ in held])
    for left, right in stats:
        alive = _survivors(alive, left, right, least - slack)

    scores = _scores(q, c) if alive.mean() > FEW else None
    for i in range(len(q_ids)):
        rest = np.flatnonzero(alive[i])
        mine, ids = held[i]
        if len(rest):
            exact = scores[i, rest] if scores is not None else _scores(q[i : i + 1], c[rest])[0]
            better = exact >= least[i]
            mine, ids = np.concatenate([mine, exact[better]]), np.concatenate([ids, c_ids[rest[better]]])
        best = _best(mine, ids, k)
        held[i] = mine[best], ids[best]


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by query block: the best of the current one are held until the next begins."""

        def found() -> Iterator[tuple]:
            block, q_ids, held = None, [], []

            def done() -> Iterator[tuple]:
                for at, (mine, (scores, ids)) in enumerate(zip(q_ids, held)):
                    yield from ((block, at, int(mine), int(v), int(s)) for s, v in zip(scores, ids))

            for batch in batches:
                for n in range(batch.num_rows):
                    row = batch.slice(n, 1).to_pylist()[0]
                    if row["q_block"] != block:
                        yield from done()
                        block, q_ids = row["q_block"], np.frombuffer(row["q_ids"], np.int64)
                        held = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in q_ids]
                        q = np.frombuffer(row["q_cells"], f"i{row['q_width']}").reshape(len(q_ids), -1).astype(np.int64)
                    c_ids = np.frombuffer(row["c_ids"], np.int64)
                    c = np.frombuffer(row["c_cells"], f"i{row['c_width']}").reshape(len(c_ids), -1).astype(np.int64)
                    top_of_blocks(q, q_ids, c, c_ids, k, held)
            yield from done()

        yield from rows_in_batches(found(), PAIR_SCHEMA)

    return search


def exact_top_k(df: DataFrame, k: int = 20, query_step: int = 20, scale: float = 64.0, id_column: str = "vec_id", vector_column: str = "embedding", query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of every query against all other rows.

    Queries are the rows whose id is divisible by ``query_step``. Runs the
    packing of blocks at once; the search itself is lazy.
    """
    vectors = whole_vectors(df, id_column, vector_column, scale)
    blocks = stored(vectors.mapInArrow(_packer(query_step, query_block, candidate_block), PACKED), "blocks")
    q, c = (
        blocks.filter(F.col("side") == side).select(*[F.col(x).alias(f"{side}_{x}") for x in ("block", "ids", "width", "cells")])
        for side in ("q", "c")
    )
    # A query block goes to every share of the candidate blocks; a share is a few blocks, and there are more with more rows.
    shares = max(1, c.count() // IN_TURN)
    pairs = q.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    pairs = pairs.join(c.withColumn("share", F.pmod(F.xxhash64("c_block"), F.lit(shares)).cast("int")), "share")
    pairs = pairs.repartition(F.xxhash64("q_block", "share")).sortWithinPartitions("q_block")
    found = pairs.select("q_block", "q_ids", "q_width", "q_cells", "c_ids", "c_width", "c_cells").mapInArrow(_searcher(k), "q_block long, at int, query_id long, vec_id long, score long")
    # A query is a row, not an id; rows of one id with the same list are one query.
    best = found.groupBy("q_block", "at", "query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v")))), 1, k).alias("best")).dropDuplicates(["query_id", "best"])
    out = best.select("query_id", F.posexplode("best").alias("place", "b"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("b.v").alias("vec_id"), (-F.col("b.s")).alias("score"))
