"""Substring dedup by level-wise doubling.

Windows of ``width`` words that also start in a document with a smaller id are
removed, word by word. Whether a window repeats is settled level by level: windows
of four words first, then only full windows around repeated ones are tried with eight
words and with the full width, and (``deepest`` permitting) with twice, four times, ... that, until
no candidate survives; the longest level a document reaches is reported.

Levels below the full width need no window of a document but the one with the smallest hash
among those of each full window: equal full windows choose equal short
windows, so a full window can repeat only if its choice does. That is about a fifth of all
positions for four words. At every level the hashes travel packed by hash bucket, where the
smallest id of each hash is found, and the answers go back to buckets of documents.
Where many documents of one task share a hash, one of them stands for all, and the
others wait with their documents for the verdict, so a hash that a third of all
documents hold fills no bucket. A document without an answer is finished at once, so
the text of the others alone moves on. Tasks hash and compare the windows of whole blocks of text at once.

Words are maximal runs of characters other than space and tab to carriage return, unchanged.

Defined cases: null and empty texts have no words; texts with fewer words than a
window keep all; rows that share an id are one document and never remove from each
other; null ids are one document after all others; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.blocks import HELD, PACKED, PACKED_DDL, bucket_count, bucket_of, bucket_order, each_group, gathered, group_starts, hash_order, text_blocks
from llm.common import ODD, as_batch, mixed, rows_in_batches, shingle_hashes, stored, word_edges, word_hashes

WIDTH = 13
#: Words of a window at the first level, at most.
LEAST = 4
#: Stands for a null id: after all others.
LAST = (1 << 63) - 1
ENTRY = np.dtype([("h", "<u8"), ("doc", "<i8")])
#: Documents of a task that may share a hash before all but one of them are parked.
SHARED = 256
ANSWER = pa.schema([("doc", pa.int64()), ("hashes", pa.binary())])
ROWS = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("longest", pa.int32()), ("text", pa.binary()), ("gone", pa.binary())])
ROWS_DDL = "doc_id long, doc long, n_words long, n_removed long, kept_sha256 string, longest int, text binary, gone binary"


@dataclass
class Scanned:
    """The words of a block of texts, and each text joined by single spaces."""

    words: np.ndarray  # hashes
    text: np.ndarray  # which text a word is in
    edges: np.ndarray  # the first word of each text, and the end
    joined: bytes
    begins: np.ndarray  # of each word in ``joined``, and the end

    def full(self, width: int) -> np.ndarray:
        """Where windows of ``width`` words start that lie in one text."""
        places = np.arange(max(0, len(self.words) - width + 1))
        return places[places + width <= self.edges[1:][self.text[places]]]

    def codes(self, k: int) -> np.ndarray:
        return self.words[self.edges[k] : self.edges[k + 1]]

    def plain(self, k: int) -> bytes:
        return self.joined[self.begins[self.edges[k]] : max(0, self.begins[self.edges[k + 1]] - 1)]


def scan_words(texts: list[bytes], join: bool = False) -> Scanned:
    data = b"\n".join([*texts, b""])
    starts, stops = word_edges(data)
    edges = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
    joined = b""
    if join:
        b = np.frombuffer(data, np.uint8).copy()
        b[stops] = 32
        kept = np.zeros(len(b) + 1, np.int8)
        kept[starts] = 1
        kept[stops + 1] -= 1
        joined = b[np.cumsum(kept[:-1], dtype=np.int8).view(bool)].tobytes()
    begins = np.concatenate([[0], np.cumsum(stops - starts + 1)])
    return Scanned(word_hashes(data, starts, stops), np.repeat(np.arange(len(texts)), np.diff(edges)), edges, joined, begins)


def choices(words: np.ndarray, half: int, width: int) -> np.ndarray:
    """For each window of ``width`` words the smallest hash among its windows of ``half`` words."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    out, spanned = shingle_hashes(words, half), 1
    while spanned <= width - half:
        step = min(spanned, width - half + 1 - spanned)
        out = np.minimum(out[:-step], out[step:])
        spanned += step
    return out


def _runs(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which choices are not those of the window before."""
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return new


def _own(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    out = np.empty(len(hashes), ENTRY)
    out["h"], out["doc"] = hashes, docs
    return out


def _once(entries: np.ndarray) -> np.ndarray:
    """One entry per hash and document, in order."""
    entries = entries.take(hash_order(entries["h"], entries["doc"]))
    return entries[_runs(entries["h"], entries["doc"])]


#: What a packed row holds, in its first byte.
ENTRIES, SUMMARY, PARKED, ANSWERS, VERDICTS = (bytes([k]) for k in range(5))


def _packed(parts: list[tuple[bytes, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows for the shuffle from (sort, entries, bucket of each)."""
    buckets, rows = [], []
    for sort, entries, bucket in parts:
        order = bucket_order(bucket)
        entries, bucket = entries.take(order), bucket[order]
        starts = group_starts(bucket)
        buckets += bucket[starts].tolist()
        rows += [sort + entries[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(bucket)))]
    if rows:
        yield as_batch(PACKED, [buckets, rows])


def _dealt(parts: Iterator[np.ndarray], buckets: int, shared: int) -> Iterator[pa.RecordBatch]:
    """Entries by bucket of their hash. Of a hash that many documents of a task share, only the smallest
    document goes there; the others are parked with their documents, in buckets below zero."""
    held: list[np.ndarray] = []
    size = 0

    def send() -> Iterator[pa.RecordBatch]:
        entries = _once(np.concatenate(held))
        starts = group_starts(entries["h"])
        sizes = np.diff(np.append(starts, len(entries)))
        often = np.repeat(sizes > shared, sizes)
        few, first, parked = entries[~often], entries[starts[sizes > shared]], entries[often]
        yield from _packed([
            (ENTRIES, few, bucket_of(few["h"], buckets)), (SUMMARY, first, bucket_of(first["h"], buckets)),
            (PARKED, parked, -1 - bucket_of(mixed(parked["doc"].astype(np.uint64)), buckets)),
        ])

    for part in parts:
        held.append(part)
        size += len(part)
        if size >= HELD:
            yield from send()
            held.clear()
            size = 0
    if size:
        yield from send()


def _of(values: list[pa.Buffer], *sorts: bytes) -> np.ndarray:
    found = [np.frombuffer(v, ENTRY, offset=1) for v in values if v[0:1].to_pybytes() in sorts]
    return np.concatenate(found) if found else np.empty(0, ENTRY)


def _repeats(buckets: int, last: bool):
    """Answers, by bucket of the document: the hashes it shares with another document; the lowest bit tells
    whether one with a smaller id has it. Parked entries move on, and a verdict on their hashes goes to all buckets.
    The ``last`` level extends nothing, so there a document needs to hear of one of those it has first."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[np.ndarray] = []
        verdicts: list[np.ndarray] = []
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            told, judged = np.concatenate(answers), np.concatenate(verdicts)
            everywhere = np.repeat(np.arange(buckets), len(judged))
            yield from _packed([(ANSWERS, told, bucket_of(mixed(told["doc"].astype(np.uint64)), buckets)), (VERDICTS, np.tile(judged, buckets), everywhere)])
            answers.clear()
            verdicts.clear()

        for bucket, values in each_group(batches):
            if bucket < 0:
                yield as_batch(PACKED, [[-1 - bucket] * len(values), [v.to_pybytes() for v in values]])
                continue
            few, first = _of(values, ENTRIES), _of(values, SUMMARY)
            entries, summary = np.concatenate([few, first]), np.repeat([False, True], [len(few), len(first)])
            order = hash_order(entries["h"], entries["doc"])
            entries, summary = entries.take(order), summary[order]
            starts = group_starts(entries["h"])
            sizes = np.diff(np.append(starts, len(entries)))
            hot = np.maximum.reduceat(summary, starts)
            least = np.repeat(entries["doc"][starts], sizes)
            several = np.repeat(hot | (np.maximum.reduceat(entries["doc"], starts) > entries["doc"][starts]), sizes) & ~summary
            told = entries[several]
            later = told["doc"] > least[several]
            told["h"] = told["h"] & ~np.uint64(1) | later
            if last:
                own = np.flatnonzero(~later)
                later[own[np.unique(told["doc"][own], return_index=True)[1]]] = True
                told = told[later]
            answers.append(told)
            verdicts.append(entries[starts[hot]])
            size += len(told)
            if size >= HELD:
                yield from send()
                size = 0
        if answers:
            yield from send()

    return find


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, hashes): all answers of a document in one row."""

    def rows() -> Iterator[tuple]:
        for _, values in each_group(batches):
            told, parked, judged = _of(values, ANSWERS), _of(values, PARKED), _of(values, VERDICTS)
            if len(parked):
                judged = judged[np.argsort(judged["h"], kind="stable")]
                at = np.searchsorted(judged["h"], parked["h"])
                parked["h"] = parked["h"] & ~np.uint64(1) | (parked["doc"] > judged["doc"][at])
            told = np.concatenate([told, parked])
            told = told[np.lexsort((told["h"], told["doc"]))]
            starts = group_starts(told["doc"])
            for a, b in zip(starts, np.append(starts[1:], len(told))):
                yield int(told["doc"][a]), np.ascontiguousarray(told["h"][a:b]).tobytes()

    yield from rows_in_batches(rows(), ANSWER, 512)


def _answers(dealt: DataFrame, buckets: int, last: bool = False) -> DataFrame:
    """(doc, hashes): one row per document that has a repeated window."""
    found = gathered(dealt, 2 * buckets).mapInArrow(_repeats(buckets, last), PACKED_DDL)
    return gathered(found, buckets).mapInArrow(_resolved, "doc long, hashes binary")


def _answered(value: bytes | None) -> np.ndarray:
    """Hashes of an answer, sorted."""
    return np.frombuffer(value, np.uint64) if value else np.empty(0, np.uint64)


def _among(hashes: np.ndarray, answer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are repeated, and which of them in a document with a smaller id."""
    if not len(answer) or not len(hashes):
        none = np.zeros(len(hashes), bool)
        return none, none
    bare = hashes & ~np.uint64(1)
    at = np.minimum(np.searchsorted(answer, bare), len(answer) - 1)
    known = answer[at] & ~np.uint64(1) == bare
    return known, known & ((answer[at] & np.uint64(1)) == 1)


def _known(hashes: np.ndarray, text: np.ndarray, answers: list[np.ndarray]) -> np.ndarray:
    """Which hashes are repeated by the answer of the text they are in, for a block of texts at once."""
    told = (np.concatenate(answers) & ~np.uint64(1)) + np.repeat(np.arange(len(answers), dtype=np.uint64), [len(a) for a in answers]) * ODD
    if not len(told):
        return np.zeros(len(hashes), bool)
    told.sort()
    asked = (hashes & ~np.uint64(1)) + text.astype(np.uint64) * ODD
    return told[np.minimum(np.searchsorted(told, asked), len(told) - 1)] == asked


def ladder(width: int) -> list[int]:
    """Widths from a few words on, each twice the one before, up to the full one."""
    levels = [min(LEAST, (width + 1) // 2)]
    while levels[-1] < width:
        levels.append(min(width, 2 * levels[-1]))
    return levels


def _is_last(level: int, width: int, deepest: int | None) -> bool:
    return level >= width and deepest is not None and 2 * level > deepest


def remove_repeats(docs: DataFrame, width: int = WIDTH, deepest: int | None = None, keep_text: bool = False, shared: int = SHARED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, longest[, kept]) for every row.

    ``longest`` is the widest level at which a window of the row repeats in another
    document (0: none); levels beyond ``deepest`` are not tried. ``keep_text`` adds
    the kept words joined by one space. ``shared`` is explained above. Levels up to
    the full width are left to Spark; those beyond run at once.
    """
    levels = ladder(width)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    narrow = narrow.withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
    buckets = bucket_count(narrow)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[np.ndarray]:
            for rows, texts in text_blocks(batches):
                x = scan_words(texts)
                places = x.full(width)
                hashes, text = choices(x.words, levels[0], width)[places], x.text[places]
                new = _runs(hashes, text)
                yield _own(hashes[new], rows.column("doc").to_numpy()[text[new]])

        yield from _dealt(entries(), buckets, shared)

    answers = _answers(narrow.select("doc", "text").mapInArrow(first, PACKED_DDL), buckets, _is_last(levels[0], width, deepest))
    for before, level in zip(levels, levels[1:]):
        # The same columns as in the join below, so that the texts are shuffled once for all levels.
        joined = narrow.join(answers, "doc").select("doc_id", "doc", "text", "hashes")
        answers = _answers(joined.mapInArrow(_extended(before, level, width, buckets, shared), PACKED_DDL), buckets, _is_last(level, width, deepest))
    level, finished = width, None
    rows = narrow.withColumn("gone", F.lit(None).cast("binary")).withColumn("longest", F.lit(0))
    while deepest is None or 2 * level <= deepest:
        joined = rows.join(answers, "doc", "left").select("doc_id", "doc", "text", "gone", "longest", "hashes")
        spread = lambda words, answer, a=level, b=2 * level: _next_level(words, answer, a, b)
        tried = stored(joined.mapInArrow(_trial(spread, level, keep_text), f"{ROWS_DDL}, candidates binary"), f"level{2 * level}")
        done = tried.filter("text IS NULL")
        finished = done if finished is None else finished.union(done)
        rows = tried.filter("text IS NOT NULL")
        answers = _answers(rows.select("doc", "candidates").mapInArrow(_send(buckets, shared), PACKED_DDL), buckets, _is_last(2 * level, width, deepest))
        rows = rows.select("doc_id", "doc", "text", "gone", "longest")
        level = 2 * level
        if deepest is None and not rows.head(1):
            break
    closing = rows.join(answers, "doc", "left").select("doc_id", "doc", "text", "gone", "longest", "hashes")
    closing = closing.mapInArrow(_trial(None, level, keep_text), f"{ROWS_DDL}, candidates binary")
    every = closing if finished is None else finished.union(closing)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "longest"]
    return every.select(*columns, F.col("gone").cast("string").alias("kept")) if keep_text else every.select(*columns)


def _extended(before: int, level: int, width: int, buckets: int, shared: int):
    """Of full windows whose chosen window of ``before`` words repeats: the chosen ones of ``level`` words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[np.ndarray]:
            for rows, texts in text_blocks(batches):
                x = scan_words(texts)
                places = x.full(width)
                hashes, text = choices(x.words, before, width)[places], x.text[places]
                new = _runs(hashes, text)
                known = _known(hashes[new], text[new], [_answered(a.as_py()) for a in rows.column("hashes")])
                places = places[known[np.cumsum(new) - 1]]
                hashes, text = choices(x.words, level, width)[places], x.text[places]
                new = _runs(hashes, text)
                yield _own(hashes[new], rows.column("doc").to_numpy()[text[new]])

        yield from _dealt(entries(), buckets, shared)

    return send


def _next_level(words: np.ndarray, answer: np.ndarray, before: int, level: int) -> np.ndarray:
    """Windows whose two halves repeat."""
    known, _ = _among(shingle_hashes(words, before), answer)
    n = len(words) - level + 1
    return np.unique(shingle_hashes(words, level)[known[:n] & known[before : before + n]]) if n > 0 else np.empty(0, np.uint64)


def _send(buckets: int, shared: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[np.ndarray]:
            for batch in batches:
                for doc, candidates in zip(batch.column("doc").to_pylist(), batch.column("candidates")):
                    yield _own(np.frombuffer(candidates.as_buffer(), np.uint64), doc)

        yield from _dealt(entries(), buckets, shared)

    return send


def _trial(spread, judged: int, keep_text: bool):
    """Judge windows of ``judged`` words by their answers, then name the candidates of the next level.

    A row without candidates is finished: it leaves with its result and without its text.
    """
    schema = pa.schema([*ROWS, ("candidates", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch, texts in text_blocks(batches):
                x = scan_words(texts, True)
                columns = (batch.column(n).to_pylist() for n in ("doc_id", "doc", "gone", "longest", "hashes"))
                for k, (doc_id, doc, gone, longest, parts) in enumerate(zip(*columns)):
                    answer, codes = _answered(parts), x.codes(k)
                    removed = np.zeros(len(codes), bool) if gone is None else np.frombuffer(gone, bool).copy()
                    if judged and len(answer):
                        known, later = _among(shingle_hashes(codes, judged), answer)
                        longest = judged if known.any() else longest
                        if later.any():
                            cover = np.zeros(len(codes) + 1, np.int64)
                            np.add.at(cover, np.flatnonzero(later), 1)
                            np.add.at(cover, np.flatnonzero(later) + judged, -1)
                            removed |= np.cumsum(cover)[:-1] > 0
                    candidates = spread(codes, answer) if spread is not None and len(answer) else np.empty(0, np.uint64)
                    if len(candidates):
                        yield doc_id, doc, None, None, None, longest, texts[k], removed.tobytes(), candidates.tobytes()
                    else:
                        kept = x.plain(k)
                        if removed.any():
                            kept = b" ".join(compress(kept.split(b" "), (~removed).tolist()))
                        yield doc_id, doc, len(codes), int(removed.sum()), hashlib.sha256(kept).hexdigest(), longest, None, kept if keep_text else None, None

        yield from rows_in_batches(rows(), schema, 256)

    return run
