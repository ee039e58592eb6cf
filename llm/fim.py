"""Fill-in-the-middle: texts cut at two code points, by a learned index from rank to byte offset.

UTF-8 has no direct way to the k-th code point. The index holds the byte offsets of
all code points of a batch of texts as a function of their rank: straight segments,
each as long as all its offsets stay within ``BOUND`` bytes of the line (a shrinking
cone of slopes), and for every rank what the line is off by, in one byte. A cut is
predicted by its segment and corrected by the stored residual, so it is exact. Most
texts need one segment; only another density of long characters starts a new one.

Python answers with the places of two cuts; Spark's own functions cut and join the
parts, and rebuild the text.

Defined cases: a null text counts as empty, and an empty one stays plain; a null id
is hashed as an empty number; repeated rows get one result each; other columns are
kept, a column called like a result is replaced; no rows give no rows. Bytes
that are not UTF-8 stay with the code point before them. Nothing is shuffled, and what
a task holds is one Arrow batch, which Spark bounds in rows and bytes, and one byte
for each of its code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

#: Bytes that an offset may be off its segment; with rounding, a residual fits one signed byte.
BOUND = 100
#: Bytes of text whose offsets are fitted at a time.
PIECE = 1 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUTS = StructType()
for _name in ("n", "first", "second", "first_byte", "second_byte"):
    CUTS.add(_name, LongType())


def fit_segments(places: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(first, end, slope) of the longest runs of ``places`` that a line from the first of them meets within ``BOUND``."""
    first, n = 0, len(places)
    while first < n:
        low, high, end, step, open_ = -np.inf, np.inf, first + 1, 64, True
        while open_ and end < n:
            rise = places[end : end + step] - places[first]
            run = np.arange(end - first, end - first + len(rise))
            lows = np.maximum(np.maximum.accumulate((rise - BOUND) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + BOUND) / run), high)
            crossed = np.flatnonzero(lows > highs)
            good = int(crossed[0]) if len(crossed) else len(run)
            if good:
                low, high = lows[good - 1], highs[good - 1]
            end, step, open_ = end + good, 2 * step, not len(crossed)
        yield first, end, (low + high) / 2 if end > first + 1 else 1.0
        first = end


class RankIndex:
    """Byte offset of every code point in ``data``, and of its end. ``marks`` are ascending offsets whose ranks are wanted."""

    def __init__(self, data: np.ndarray, marks: np.ndarray):
        self.size, self.ranks = 0, np.zeros(len(marks), np.int64)
        first, base, slope, residuals = [], [], [], []
        for at in range(0, max(1, len(data)), PIECE):
            part = data[at : at + PIECE]
            places = np.flatnonzero((part & 0xC0) != 0x80) + at
            if at + PIECE >= len(data):
                places = np.append(places, len(data))
            a, b = np.searchsorted(marks, [at, at + len(part)])
            b = len(marks) if at + PIECE >= len(data) else b
            self.ranks[a:b] = self.size + np.searchsorted(places, marks[a:b])
            for i, j, k in fit_segments(places):
                first.append(self.size + i)
                base.append(places[i])
                slope.append(k)
                residuals.append((places[i:j] - places[i] - np.floor(k * np.arange(j - i))).astype(np.int8))
            self.size += len(places)
        self.first, self.base, self.slope = np.array(first), np.array(base), np.array(slope)
        self.residuals = np.concatenate(residuals)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets: the segment's prediction and the stored residual."""
        own = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[own] + np.floor(self.slope[own] * (ranks - self.first[own])).astype(np.int64) + self.residuals[ranks]


def _contents(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins, with the end."""
    wide = texts.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


@F.arrow_udf(CUTS)
def _cuts(texts: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """Code points, and the two cuts (a number modulo one more than those) in order: code points and bytes before them."""
    data, starts = _contents(texts)
    index = RankIndex(data, starts)
    n = np.diff(index.ranks)
    a, b = (x.to_numpy(zero_copy_only=False).astype(np.int64) % (n + 1) for x in (one, other))
    first, second = np.minimum(a, b), np.maximum(a, b)
    places = [np.clip(index.offsets(index.ranks[:-1] + cut) - starts[:-1], 0, np.diff(starts)) for cut in (first, second)]
    return pa.StructArray.from_arrays([pa.array(x) for x in (n, first, second, *places)], CUTS.names)


def _number(digest: Column, group: int) -> Column:
    """One of the groups of eight hexadecimal digits, from 1, as a number."""
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """``docs`` with n, form (plain, psm, spm), prefix_chars, middle_chars and output.

    Cuts and form are drawn from the hash of ``seed`` and doc_id: of 100 documents
    ``plain_from`` are cut, and of those ``spm_below`` in 100 have the suffix first. A
    text that is empty or holds one of the three marks stays plain.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    marked = [F.coalesce(F.col("text"), F.lit("")).contains(mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.octet_length(data) == 0) | marked[0] | marked[1] | marked[2] | (_number(digest, 3) % 100 >= plain_from)
    form = F.when(plain, "plain").when(_number(digest, 4) % 100 < spm_below, "spm").otherwise("psm")
    kept = [c for c in docs.columns if c not in {"n", "form", "prefix_chars", "middle_chars", "output"}]
    rows = docs.select(F.struct(*kept).alias("row"), data.alias("data"), form.alias("form"), _cuts(data, _number(digest, 1), _number(digest, 2)).alias("cut"))
    a, b = F.col("cut.first_byte").cast("int"), F.col("cut.second_byte").cast("int")
    prefix, middle = F.substring("data", F.lit(1), a), F.substring("data", a + 1, b - a)
    suffix = F.substring("data", b + 1, F.octet_length("data"))
    mark = lambda x: F.lit(x).cast("binary")
    psm = F.concat(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle)
    spm = F.concat(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle)
    made = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("data"))
    cut = F.col("form") != "plain"
    return rows.select(
        "row.*", F.col("cut.n").alias("n"), "form", F.when(cut, F.col("cut.first")).alias("prefix_chars"),
        F.when(cut, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"), made.cast("string").alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text again. No mark can be read wrongly: cut texts hold none, and none begins inside another."""
    between = lambda text, left, right: F.substring_index(F.substring_index(text, right, 1), left, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(output, PREFIX, SUFFIX), middle, between(output, SUFFIX, MIDDLE))
    spm = F.concat(between(output, PREFIX, MIDDLE), middle, between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
