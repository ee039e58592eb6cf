"""Benchmark decontamination by spaced seeds.

A mask picks some of the next words and ignores the others. Hashes of the picked
words are made at every position of every benchmark item and every document; a
common hash is a hit, whatever stands at the ignored positions. Hits are joined by
hash, and around each the two texts are aligned word by word: an overlap is the
longest stretch that begins and ends with an equal word, has ``min_words`` equal
words (or all words of a shorter item) and of whose words ``similarity`` are equal.
So a copied passage is found though words in it were replaced, if a mask fits
somewhere between them.

Words are compared without case and without marks. A bit table of the benchmark's
hashes, of bounded size, goes to the scan, so only positions that can have a
partner are written; the join itself is exact. With up to ``BROADCAST`` seeds the
hashes themselves go along too, and the seeds are broadcast in the join.

Defined cases: null and empty texts have no overlaps; items with fewer words than
every mask spans are too short to be told from chance and never match; a null item
id is kept; rows that repeat id and text are reported once; other columns are
ignored; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import bit_table, in_table, packed_bits
from llm.common import ODD, REMEMBERED, mixed, row_key, rows_in_batches, stored

MASKS = ("110110101", "111001011", "1011010011")
MIN_WORDS, SIMILARITY = 12, 0.8
BROADCAST = 200_000
RUN = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("run", pa.int64()), ("first", pa.int64()), ("words", pa.binary()),
    ("mask", pa.list_(pa.int32())), ("at", pa.list_(pa.int64())), ("hash", pa.list_(pa.int64())),
])
FOUND = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64()), ("n_equal", pa.int64())])


class _Bare(dict):
    """Hash of a word without case and marks; 0 if nothing is left of it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        bare = re.sub(r"[\W_]+", "", word.decode("utf-8", "replace").lower())
        self[word] = value = (xxhash.xxh3_64_intdigest(bare) >> 1) | 1 if bare else 0
        return value


_BARE = _Bare()


def bare_words(text: bytes | None) -> np.ndarray:
    words = (text or b"").split()
    codes = np.fromiter(map(_BARE.__getitem__, words), np.uint64, len(words))
    return codes[codes > 0]


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the picked words at every position at which the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    picked = [k for k, bit in enumerate(mask) if bit == "1"]
    out = words[picked[0] : picked[0] + n].copy()
    for k in picked[1:]:
        out = out * ODD + words[k : k + n]
    return mixed(out).view(np.int64)


def longest_overlap(same: np.ndarray, least: int, similarity: Fraction) -> tuple[int, int] | None:
    """(begin, end) of the longest stretch from an equal word to an equal word with ``least`` equal ones and that share; the first such.

    A stretch has the share if its sum of 1 - share for an equal word and -share for another
    is not negative. Of the beginnings that reach this for an end, the first makes the longest
    stretch and holds the most equal words.
    """
    equal = np.concatenate([[0], np.cumsum(same)])
    sums = equal * similarity.denominator - np.arange(len(equal)) * similarity.numerator
    begins, ends = np.flatnonzero(same), np.flatnonzero(same) + 1
    if len(begins) < max(least, 1):
        return None
    low = np.minimum.accumulate(sums[begins])
    first = begins[np.minimum(np.searchsorted(-low, -sums[ends]), np.arange(len(ends)))]
    length = np.where((equal[ends] - equal[first] >= least) & (sums[ends] >= sums[first]), ends - first, 0)
    best = int(np.argmax(length))
    return (int(first[best]), int(ends[best])) if length[best] else None


def benchmark_overlaps(
    docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, key, item_id, start, item_start, length, n_equal): overlaps in words of whole documents with benchmark items.

    ``key`` is the ``row_key`` of id (a long) and text, which tells documents apart that repeat an id or have none.

    Runs the scan for hits at once; join and alignment are lazy.
    """
    spark = docs.sparkSession
    share = Fraction(str(similarity))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.binary()), ("mask", pa.list_(pa.int32())), ("item_at", pa.list_(pa.int64())), ("hash", pa.list_(pa.int64()))])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for item, item_id, text in zip(*(batch.column(n).to_pylist() for n in ("item", "item_id", "text"))):
                    words = bare_words(text)
                    made = [(m, seeds(words, mask)) for m, mask in enumerate(masks)]
                    if any(len(h) for _, h in made):
                        yield item, item_id, words.tobytes(), np.concatenate([np.full(len(h), m) for m, h in made]).tolist(), np.concatenate([np.arange(len(h)) for _, h in made]).tolist(), np.concatenate([h for _, h in made]).tolist()

        yield from rows_in_batches(rows(), schema, 256)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).withColumn("item", row_key("item_id", "text")).dropDuplicates(["item"])
    items = stored(items.mapInArrow(item_seeds, "item long, item_id long, item_words binary, mask array<int>, item_at array<long>, hash array<long>"), "items")
    flat = items.select("item", F.explode(F.arrays_zip("mask", "item_at", "hash")).alias("s")).select("item", "s.mask", "s.item_at", "s.hash")
    size = items.agg(F.coalesce(F.sum(F.size("hash")), F.lit(0)).alias("seeds"), F.coalesce(F.max(F.length("item_words")), F.lit(0)).alias("bytes")).first()
    reach = size["bytes"] // 8
    few = size["seeds"] <= BROADCAST
    if few:
        known = np.array(sorted({r[0] for r in flat.select("hash").distinct().collect()}), np.int64)  # at most BROADCAST
        table = packed_bits(known)
    else:
        known, table = None, bit_table(flat, "hash")
    filters = spark.sparkContext.broadcast((table, known))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = filters.value

        def runs() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("text")):
                    words = bare_words(text.as_py())
                    hits = []
                    for m, mask in enumerate(masks):
                        hashes = seeds(words, mask)
                        at = np.flatnonzero(in_table(table, hashes))
                        if known is not None and len(at):
                            near = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
                            at = at[known[near] == hashes[at]]
                        hits += [(int(p), m, int(hashes[p])) for p in at]
                    hits.sort()
                    begin = 0
                    for k in range(1, len(hits) + 1):
                        # Hits further apart than an item reaches have nothing to do with each other.
                        if k == len(hits) or hits[k][0] - hits[k - 1][0] > reach:
                            run = hits[begin:k]
                            first = max(0, run[0][0] - reach)
                            yield doc_id, key, run[0][0], first, words[first : run[-1][0] + reach].tobytes(), [h[1] for h in run], [h[0] for h in run], [h[2] for h in run]
                            begin = k

        yield from rows_in_batches(runs(), RUN, 512)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).withColumn("key", row_key("doc_id", "text"))
    runs = narrow.select("doc_id", "key", F.col("text").cast("binary").alias("text")).mapInArrow(
        scan, "doc_id long, key long, run long, first long, words binary, mask array<int>, at array<long>, hash array<long>"
    )
    runs = stored(runs, "runs")
    hits = runs.select("key", "run", F.explode(F.arrays_zip("mask", "at", "hash")).alias("h")).select("key", "run", "h.mask", "h.at", "h.hash")
    pairs = hits.join(F.broadcast(flat) if few else flat, ["mask", "hash"])
    pairs = pairs.select("key", "run", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    pairs = pairs.join(runs.select("key", "run", "doc_id", "first", "words").dropDuplicates(["key", "run"]), ["key", "run"])
    pairs = pairs.join(items.select("item", "item_id", "item_words"), "item")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_pylist():
                    words, item = (np.frombuffer(r[n], np.uint64) for n in ("words", "item_words"))
                    shift = r["shift"] - r["first"]  # place in ``words`` of the item's first word
                    a, b = max(0, -shift), min(len(item), len(words) - shift)
                    same = words[a + shift : b + shift] == item[a:b]
                    if not len(same):
                        continue
                    stretch = longest_overlap(same, min(min_words, len(item)), share)
                    if stretch:
                        begin, end = stretch
                        yield r["doc_id"], r["key"], r["item_id"], r["first"] + shift + a + begin, a + begin, end - begin, int(same[begin:end].sum())

        yield from rows_in_batches(found(), FOUND)

    pairs = pairs.select("doc_id", "key", "first", "words", "shift", "item_id", "item_words")
    return pairs.mapInArrow(align, "doc_id long, key long, item_id long, start long, item_start long, length long, n_equal long")
