"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier line (smaller document id, then line number) has the same
words, or, from ``near_words`` words on, words at an edit distance of one: one word
replaced, added or missing. Lines are judged on the input, not on what is left.

Equal lines are found by hash. For near ones, every line of enough words has a
neighbourhood: itself and itself without each word, each hashed as a key. Lines
that share a key are joined: without the same word place they differ by one
replaced word; a whole line that equals another without one word differs by that
word. Only the earliest of a group matters, so no pairs are made within groups.
Each pair found is then verified by its edit distance over the words themselves.

Two lines at distance one agree in their first or in their last half. So halves are
counted first, and a line sends only the part of its neighbourhood that a shared
half leaves open. The halves that occur in different lines go to the scan as a
table of bits of bounded size; where it is too full it lets more pass, never less.
Scans work on whole blocks of text at a time: words are hashed eight bytes at a time, and
sums of their powers give the hash of any run of words.

Defined cases: lines end at a line feed; lines without words are never removed, and
white space within a line does not count; null and empty texts have no lines to
remove; null ids count as one id after all others; rows that share an id tie, and
of equal lines in them all that tie for the first place stay; a null text stays
null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import BLOCK, PACKED_DDL, bit_table, bucket_count, each_bucket, gathered, group_starts, hash_order, in_table, maybe_among, packed, shared_with_next, text_blocks
from llm.common import ODD, mixed, row_key, rows_in_batches, stored, word_edges, word_hashes

NEAR_WORDS = 8
LAST = (1 << 63) - 1
LINES = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("line", pa.int32()), ("n", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("k3", pa.int64())])
LINES_DDL = "h long, doc long, key long, line int, n int, k1 long, k2 long, k3 long"
#: ``of``: the line; ``at``: the place of the word left out, -1 for none.
ENTRY = np.dtype([("h", "<u8"), ("of", "<i8"), ("at", "<i4"), ("n", "<i4")])
MEMBER = pa.schema([("group", pa.int64()), ("side", pa.int32()), ("h", pa.int64())])
#: Sides of a group: lines of one length with one word left out; whole lines; lines that equal them without a word.
REPLACED, WHOLE, LONGER = 0, 1, 2

BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """At least n powers of the base and of its inverse, modulo 2^64; kept per worker."""
    if len(_POWERS[0]) < n:
        size = max(n, BLOCK + 1)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


@dataclass
class Scanned:
    """The lines with words of a block of texts, and sums from which runs of words are hashed."""

    sums: np.ndarray
    starts: np.ndarray  # of each line, in words
    stops: np.ndarray
    text: np.ndarray  # which text a line is in
    line: np.ndarray  # its number there
    bytes_from: np.ndarray
    bytes_to: np.ndarray

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * _powers(len(self.sums))[1][a]

    def sequence(self, value: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mixed(value + n.astype(np.uint64) * ODD)

    def hashes(self) -> np.ndarray:
        return self.sequence(self.run(self.starts, self.stops), self.stops - self.starts)

    def first(self, k: np.ndarray) -> np.ndarray:
        return mixed(self.run(self.starts, self.starts + k) ^ (k * 2 + 1).astype(np.uint64) * ODD)

    def last(self, k: np.ndarray) -> np.ndarray:
        return mixed(self.run(self.stops - k, self.stops) ^ (k * 2 + 2).astype(np.uint64) * ODD)

    def halves(self) -> list[np.ndarray]:
        """Three keys a line: first and last halves for its length and for one word more. Near lines share one."""
        n = self.stops - self.starts
        third = np.where(n % 2 == 0, self.last(np.minimum(n // 2 + 1, n)), self.first((n + 1) // 2))
        return [self.first(n // 2), self.last((n + 1) // 2), third]


def scan_lines(texts: list[bytes]) -> Scanned:
    data = b"\n".join(texts)
    starts, stops = word_edges(data)
    words = word_hashes(data, starts, stops)
    feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    # The first word after each line feed, and the lines, numbered over all texts, that have words.
    after = np.concatenate([[0], np.searchsorted(starts, feeds), [len(starts)]])
    numbers = np.flatnonzero(after[1:] > after[:-1])
    at, ends = after[numbers], after[numbers + 1]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    first_line = np.searchsorted(feeds, begins)
    text = np.searchsorted(begins, starts[at], "right") - 1
    word_sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(len(words) + 1)[0][: len(words)])])
    return Scanned(word_sums, at, ends, text, (numbers - first_line[text]).astype(np.int32), starts[at], stops[ends - 1])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(doc, key, texts) of about ``BLOCK`` bytes at a time."""
    for rows, texts in text_blocks(batches):
        yield *(rows.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "key")), texts


def _line_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc, key, texts in _blocks(batches):
        x = scan_lines(texts)
        numbers = [v.view(np.int64) for v in (x.hashes(), *x.halves())]
        arrays = [numbers[0], doc[x.text], key[x.text], x.line, (x.stops - x.starts).astype(np.int32), *numbers[1:]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], schema=LINES)


def neighbourhood(x: Scanned, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Entries of the lines ``rows``: whole, and without each word at a place below ``low`` or from ``high`` on."""
    starts, stops = x.starts[rows], x.stops[rows]
    n = stops - starts
    of = x.hashes()[rows]
    sizes = low + n - high
    owner = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.where(place < low[owner], place, place - low[owner] + high[owner])
    a = starts[owner] + place
    inverse = _powers(len(x.sums) + 1)[1]
    left = x.run(starts[owner], a) + (x.sums[stops[owner]] - x.sums[a + 1]) * inverse[starts[owner] + 1]
    out = np.empty(len(owner) + len(rows), ENTRY)
    out["h"] = np.concatenate([x.sequence(left, n[owner] - 1), of])
    out["of"] = np.concatenate([of[owner], of]).view(np.int64)
    out["at"] = np.concatenate([place, np.full(len(rows), -1)])
    out["n"] = np.concatenate([n[owner], n])
    return out


def _neighbours(table, near_words: int, buckets: int):
    """Neighbourhoods of lines that share a half with another line, once per line and task."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def entries() -> Iterator[np.ndarray]:
            for _, _, texts in _blocks(batches):
                x = scan_lines(texts)
                n = x.stops - x.starts
                first, last, third = (in_table(table.value, k.view(np.int64)) for k in x.halves())
                even = n % 2 == 0
                high = np.where(first, n // 2, np.where(third & ~even, (n + 1) // 2, n))
                low = np.where(last, n // 2, np.where(third & even, n // 2 - 1, 0))
                rows = np.flatnonzero((n >= near_words - 1) & ((low > 0) | (high < n)))
                new = []
                for row, h in zip(rows, x.hashes()[rows].tolist()):
                    if h not in seen:
                        if len(seen) > 300_000:
                            seen.clear()
                        seen.add(h)
                        new.append(row)
                rows = np.array(new, np.int64)
                yield neighbourhood(x, rows, low[rows], high[rows])

        yield from packed(entries(), buckets)

    return send


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of every group of neighbours, with their side."""

    def rows() -> Iterator[tuple]:
        for entries in each_bucket(batches, ENTRY):
            entries = entries.take(hash_order(entries["h"], entries["of"], entries["at"], entries["n"]))
            entries = entries[shared_with_next(entries["h"])]
            new = np.ones(len(entries), bool)
            new[1:] = entries[1:] != entries[:-1]
            entries = entries[new]
            starts = group_starts(entries["h"])
            stops = np.append(starts[1:], len(entries))
            several = np.flatnonzero(stops - starts > 1)
            for a, b in zip(starts[several], stops[several]):
                group = entries[a:b]
                name = int(group["h"][0].view(np.int64))
                whole, shorter = group[group["at"] < 0], group[group["at"] >= 0]
                longer = shorter[np.isin(shorter["n"], whole["n"] + 1)] if len(whole) else shorter[:0]
                if len(longer):
                    yield from ((name, WHOLE, h) for h in set(whole["of"].tolist()))
                    yield from ((name, LONGER, h) for h in set(longer["of"].tolist()))
                spots: dict[tuple, list[int]] = {}
                for n, at, h in zip(shorter["n"].tolist(), shorter["at"].tolist(), shorter["of"].tolist()):
                    spots.setdefault((n, at), []).append(h)
                for (n, at), lines in spots.items():
                    if len(lines) > 1:
                        spot = int(mixed(np.array([(int(group["h"][0]) + at * int(ODD)) % (1 << 64)], np.uint64)).view(np.int64)[0])
                        yield from ((spot, REPLACED, h) for h in lines)

    yield from rows_in_batches(rows(), MEMBER)


def _words_of(table):
    """(h, words) of the lines in the table of bits, once per line and task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("words", pa.binary())])
        seen: set[int] = set()

        def rows() -> Iterator[tuple]:
            for _, _, texts in _blocks(batches):
                x, data = scan_lines(texts), b"\n".join(texts)
                hashes = x.hashes().view(np.int64)
                for i in np.flatnonzero(in_table(table.value, hashes)):
                    h = int(hashes[i])
                    if h not in seen:
                        if len(seen) > 300_000:
                            seen.clear()
                        seen.add(h)
                        yield h, b" ".join(data[x.bytes_from[i] : x.bytes_to[i]].split())

        yield from rows_in_batches(rows(), schema)

    return read


def one_apart(a: list[bytes], b: list[bytes]) -> bool:
    """Edit distance over words of at most one."""
    if len(a) < len(b):
        a, b = b, a
    p = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[p + 1 :] == (b[p + 1 :] if len(a) == len(b) else b[p:])


def _verified(near_words: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64())])
        for batch in batches:
            kept = []
            for h, x, y in zip(*(batch.column(n).to_pylist() for n in ("h", "words", "others"))):
                x, y = x.split(), y.split()
                if max(len(x), len(y)) >= near_words and one_apart(x, y):
                    kept.append(h)
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], schema=schema)

    return verify


def near_lines(narrow: DataFrame, every: DataFrame, lines: DataFrame, near_words: int) -> DataFrame:
    """(h): distinct lines that have an earlier line at an edit distance of one."""
    context = narrow.sparkSession.sparkContext
    keys = every.filter(F.col("n") >= near_words - 1).select("h", F.explode(F.array("k1", "k2", "k3")).alias("half"))
    shared = keys.groupBy("half").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("half")
    table = context.broadcast(bit_table(stored(shared, "halves"), "half"))
    buckets = bucket_count(narrow)
    sent = narrow.mapInArrow(_neighbours(table, near_words, buckets), PACKED_DDL)
    members = stored(gathered(sent, buckets).mapInArrow(_members, "group long, side int, h long"), "members")
    placed = members.join(lines.select("h", "first"), "h")
    lead = placed.groupBy("group", "side").agg(F.min(F.struct("first", "h")).alias("lead"))
    # A replaced word is looked for on the same side, a missing one on the other.
    facing = lead.select("group", F.when(F.col("side") == WHOLE, LONGER).when(F.col("side") == LONGER, WHOLE).otherwise(REPLACED).alias("side"), "lead")
    pairs = placed.join(facing, ["group", "side"]).filter((F.col("lead.h") != F.col("h")) & (F.col("lead.first") < F.col("first")))
    pairs = stored(pairs.select("h", F.col("lead.h").alias("other")).distinct(), "pairs")
    wanted = pairs.select("h").union(pairs.select(F.col("other").alias("h"))).distinct()
    words = narrow.mapInArrow(_words_of(context.broadcast(bit_table(stored(wanted, "wanted"), "h"))), "h long, words binary")
    words = stored(words.dropDuplicates(["h"]), "words")
    both = pairs.join(words, "h").join(words.select(F.col("h").alias("other"), F.col("words").alias("others")), "other")
    return both.select("h", "words", "others").mapInArrow(_verified(near_words), "h long").distinct()


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """All columns of ``docs``, with ``text`` less its removed lines, and n_lines and n_removed (of lines with words).

    Runs the finding of lines at once; rebuilding the texts is lazy. Only rows that
    lose lines are moved to be joined with what they lose.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    narrow = docs.select(doc.alias("doc"), row_key("doc_id", "text").alias("key"), F.col("text").cast("binary").alias("text"))
    every = stored(narrow.mapInArrow(_line_scan, LINES_DDL), "lines")
    lines = stored(every.groupBy("h").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n")), "distinct")
    near = near_lines(narrow, every, lines, near_words).withColumn("near", F.lit(True))
    judged = lines.join(near, "h", "left").filter("near OR n > 1").select("h", "first", "near")
    gone = every.select("h", "doc", "key", "line").join(judged, "h")
    gone = gone.filter(F.coalesce("near", F.lit(False)) | (F.struct("doc", "line") != F.col("first")))
    gone = stored(gone.groupBy("key").agg(F.collect_set("line").alias("at")), "gone")
    may_lose = maybe_among(gone.select("key"), "key")

    @F.pandas_udf("string")
    def rebuilt(text: pd.Series, at: pd.Series) -> pd.Series:
        out = []
        for t, a in zip(text, at):
            lost = set(a) if a is not None else ()
            out.append("\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost) if len(lost) else t)
        return pd.Series(out)

    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    full = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D][^\n]*+"))
    rows = docs.select(*names, row_key("doc_id", "text").alias("__key"), F.coalesce(full, F.lit(0)).alias("n_lines"))
    rows = rows.withColumn("__some", may_lose("__key"))
    whole = rows.filter(~F.col("__some")).withColumn("n_removed", F.lit(0))
    some = rows.filter("__some").join(gone.withColumnsRenamed({"key": "__key", "at": "__at"}), "__key", "left")
    some = some.withColumn("n_removed", F.coalesce(F.size("__at"), F.lit(0))).withColumn("text", rebuilt("text", "__at"))
    columns = [*names, "n_lines", "n_removed"]
    return whole.select(columns).union(some.select(columns))
