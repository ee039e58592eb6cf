"""Best-fit packing of documents into sequences by bin completion with branch and bound.

Pieces of one length are alike, so the search runs on counts per length (at most
``capacity`` of them, whatever the corpus). It fills a sequence around the longest
piece left by every undominated filling in turn, least waste first, takes the
filling as often as the counts allow, then less often, and backs up where the
sequences used so far plus the least number that the rest needs reach the
incumbent, or where the same rest was reached with as few sequences before. The first incumbent is best-fit decreasing
over the same counts; a solution that meets ceil(tokens / capacity) ends the
search. Packing is NP-hard: after ``nodes`` steps the incumbent stands, which
alone bounds the time, never the input.

The plan is a few thousand intervals of ranks within a length. Spark ranks the
pieces (by length and bucket, so that a frequent length is shared by many tasks)
and looks up each piece's place.

Defined cases: null or empty texts are one separator; a null id is kept as null;
repeated ids and rows are packed each; longer documents are cut every
``capacity`` tokens; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import as_batch, stored
from llm.tokens import word_tokens

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
#: Pieces of one length that one task ranks.
RANKED = 5_000
#: Steps of the search: fillings taken, attempts that came to nothing, and ways back.
NODES = 20_000

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, separator: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = word_tokens(tokenizer), np.array([separator], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([tokens.of(text.as_py()), end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
            if rows:
                yield as_batch(PIECES, list(zip(*rows)))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: sequences in the same state move together."""
    groups: dict[int, list[list]] = {}  # room left: [pattern, how many sequences]
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append([pattern, n])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fits = capacity // length
                full, rest = divmod(left, fits)
                if full:
                    put(capacity - fits * length, ((length, fits),), full)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            room = rooms[at]
            group = groups[room]
            pattern, n = group.pop()
            if not group:
                del groups[room], rooms[at]
            fits = min(room // length, left)
            taken = min(n, left // fits)
            if taken < n:
                put(room, pattern, n - taken)
            put(room - fits * length, (*pattern, (length, fits)), taken)
            left -= taken * fits
    return [(tuple(p), n) for group in groups.values() for p, n in group]


def _sums(counts: np.ndarray, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Lengths in rising order, how many there are of each, and per place the sums that the lengths below it can make, as bits."""
    lengths = np.flatnonzero(counts).tolist()
    many = counts[lengths].tolist()
    all_bits, bits = (1 << capacity + 1) - 1, 1
    sums = [bits]
    for length, n in zip(lengths, many):
        n, part = min(n, capacity // length), 1
        while n > 0:  # 1, 2, 4, ... copies and what is left make every number of copies
            part = min(part, n)
            bits |= bits << part * length & all_bits
            n -= part
            part *= 2
        sums.append(bits)
    return lengths, many, sums


#: The sums in use last; a search goes deep, and those of the others are made again when it comes back.
_recent: deque[list] = deque()
RECENT = 32


def fillings(counts: np.ndarray, capacity: int, most_waste: int | None = None) -> Iterator[tuple[int, Pattern] | None]:
    """(waste, pattern) of every undominated filling around the longest length that is left, least waste first, up to ``most_waste``.

    For each waste, longest length first and most copies first, down to none. A filling to
    which a remaining piece could be added, or in which one piece could give way to a longer
    one, is dominated and left out. None stands for an attempt that came to nothing.
    ``counts`` must be the same whenever the next one is asked for.
    """
    own: list[tuple[list[int], list[int], list[int]]] = []

    def look() -> tuple[list[int], list[int], list[int]]:
        if not own:
            own.append(_sums(counts, capacity))
            _recent.append(own)
            if len(_recent) > RECENT:
                _recent.popleft().clear()
        return own[0]

    def deeper(top: int, need: int, waste: int, above: int, used: Pattern) -> Iterator[tuple[int, Pattern] | None]:
        """Fillings that make ``need`` of the lengths below place ``top``; ``above`` is the least longer length with pieces left."""
        if not need:
            yield None if top and look()[0][0] <= waste else (waste, used)
            return
        at, tried = min(top, bisect_right(look()[0], need)) - 1, False
        if at + 1 < top:
            above = look()[0][at + 1]
        while at >= 0 and above > waste and look()[2][at + 1] >> need & 1:
            length, many = look()[0][at], look()[1][at]
            if above - length > waste:
                for n in range(min(need // length, many), 0, -1):
                    if n < many and length <= waste:
                        break
                    if look()[2][at] >> need - n * length & 1:
                        tried = True
                        yield from deeper(at, need - n * length, waste, length if n < many else above, (*used, (length, n)))
            above = length
            at -= 1
        if not tried:
            yield None

    last, longest, many = len(look()[0]) - 1, look()[0][-1], look()[1][-1]
    for waste in range(min(capacity - longest, capacity if most_waste is None else most_waste) + 1):
        for n in range(min((capacity - waste) // longest, many), 0, -1):
            if n < many and longest <= waste:
                break
            need = capacity - waste - n * longest
            if look()[2][last] >> need & 1:
                yield from deeper(last, need, waste, longest if n < many else 2 * capacity + 1, ((longest, n),))


def _turns(most: int) -> Iterator[int]:
    """How often in a row a filling is taken: most first, then halves, down to once, from which every other number follows."""
    while most:
        yield most
        most //= 2


def pack_counts(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences follow each, in as few sequences as the search finds."""
    if not counts:
        return []
    total = sum(length * n for length, n in counts.items())
    least = -(-total // capacity)
    incumbent = best_fit(counts, capacity)
    fewest = sum(n for _, n in incumbent)
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    path: list[tuple[Pattern, int]] = []
    used = steps = 0
    remaining = total
    reached: dict[bytes, int] = {}  # what is left, as a digest: sequences used on the best way there

    def options() -> Iterator[tuple[Pattern, int] | None]:
        """Fillings of what is left and how often each is taken, while their waste can still beat the incumbent."""
        for option in fillings(left, capacity, (fewest - 1 - used) * capacity - remaining):
            if option is None:
                yield None
                continue
            waste, pattern = option
            if waste > (fewest - 1 - used) * capacity - remaining:
                return  # the incumbent is better by now, and the others waste as much or more
            for times in _turns(min(int(left[length]) // n for length, n in pattern)):
                yield pattern, times

    frames = [options()]
    while frames and fewest > least and steps < nodes:
        steps += 1
        option = next(frames[-1], ())
        if option is None:
            continue
        if not option:
            frames.pop()
            if path:
                pattern, times = path.pop()
                for length, n in pattern:
                    left[length] += n * times
                used -= times
                remaining += times * sum(length * n for length, n in pattern)
            continue
        pattern, times = option
        size = sum(length * n for length, n in pattern)
        if used + times + -(-(remaining - times * size) // capacity) >= fewest:
            continue  # the waste so far already costs what the incumbent costs
        for length, n in pattern:
            left[length] -= n * times
        path.append((pattern, times))
        used += times
        remaining -= times * size
        state = blake2b(left, digest_size=16).digest()
        if not remaining:
            incumbent, fewest = list(path), used
            frames.append(iter(()))
        elif reached.get(state, fewest) <= used:
            frames.append(iter(()))
        else:
            reached[state] = used
            frames.append(options())
    return incumbent


def plan(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, per sequence, offset): which ranks of a length go where."""
    rows, taken, base = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, n in pattern:
            rows.append((length, taken.get(length, 0), base, n, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0, nodes: int = NODES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document.

    Runs the tokenising and the count by length at once; placing is lazy.
    """
    spark = docs.sparkSession
    pieces = stored(cut_documents(docs, tokenizer, capacity, separator), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    place = spark.sparkContext.broadcast(plan(pack_counts(counts, capacity, nodes)))

    buckets = max(1, sum(counts.values()) // RANKED)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("own", own).join(sizes.select("length", "bucket", before.alias("before")), ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("own") - 1)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = pa.schema([*PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = place.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            turn, within = np.divmod(rank - row[:, 1], row[:, 3])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(row[:, 2] + turn), pa.array(row[:, 4] + within * length)], schema=schema)

    return ranked.select(*names, "rank").mapInArrow(assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
