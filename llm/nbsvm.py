"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss fit.

A text's distinct n-grams are hashed into ``1 << BITS`` buckets. From labelled
texts each bucket gets the log ratio of its smoothed shares in the two classes;
an indicator counts that ratio. A linear hinge-loss model over the scaled
indicators is fitted by dual coordinate descent, and a logistic curve over the
margins of rows kept out of that fit, weighted by how frequent the classes are
among all labels, turns margins into probabilities.

Two sorts of n-grams: ``word_grams`` (one and two words, and one to three word
shapes: case, closing marks, a word that repeats the one before) and
``character_grams`` (three to five characters, case folded).

The fit runs in one task on at most ``per_class`` labelled rows of either class,
drawn by a hash of the id: the bound is the parameter, however many labels there
are. Class frequencies are counted over all labels. Scoring is one pass over all
texts with the weights broadcast (4 bytes a bucket).

Defined cases: null and empty texts have no n-grams and get the score of the
intercept; rows with a null id are scored and never trained on; a null label is
no label; an id labelled several times counts as its highest label; repeated rows
are scored each; if a class has no labelled text, every score is the smoothed
share of label 1; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ODD, REMEMBERED, as_batch, mixed

BITS = 20
PER_CLASS = 2_000
Grams = Callable[[bytes], np.ndarray]


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return np.unique((hashes >> np.uint64(64 - BITS)).astype(np.int32))


def _runs(codes: np.ndarray, widths: range, salt: int) -> list[np.ndarray]:
    """Hashes of all runs of each width."""
    out, run = [], codes
    for width in range(1, widths.stop):
        if width > 1:
            run = run[:-1] * ODD + codes[width - 1 :]
        if width >= widths.start:
            out.append(mixed(run + np.uint64(salt * 16 + width)))
        if len(run) < 2:
            break
    return out


def shape(word: str) -> int:
    """Case, presence of digits, and the sort of marks at the end: below 32."""
    bare = word.rstrip(".,!?;:|*#$%&-")
    marks = word[len(bare) :]
    if not bare:
        case = 0
    elif bare.islower():
        case = 1
    elif bare.isupper():
        case = 2 if len(bare) > 1 else 3
    elif bare.istitle():
        case = 4
    else:
        case = 5 if any(c.isdigit() for c in bare) else 6
    end = 0 if not marks else 1 if marks == "," else 2 if marks in ".?" or marks == "!" else 3
    return case * 4 + end


class _Words(dict):
    """Hash of a word above five bits of its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = (xxhash.xxh3_64_intdigest(word) >> 6 << 5) | shape(word.decode("utf-8", "replace"))
        return value


_WORDS = _Words()
SAME = np.uint64(31)


def word_grams(text: bytes) -> np.ndarray:
    words = text.split()
    if not words:
        return np.empty(0, np.int32)
    codes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    shapes = codes & np.uint64(31)
    shapes[1:][codes[1:] == codes[:-1]] = SAME
    return _buckets(np.concatenate(_runs(codes, range(1, 3), 1) + _runs(shapes + np.uint64(1), range(1, 4), 2)))


def character_grams(text: bytes) -> np.ndarray:
    folded = re.sub(r"\s+", " ", text.decode("utf-8", "replace").lower())
    codes = np.frombuffer(f" {folded} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    runs = _runs(codes, range(3, 6), 3)
    return _buckets(np.concatenate(runs)) if text and runs else np.empty(0, np.int32)


def dual_coordinate_descent(indptr, indices, values, y, cost=1.0, epochs=30, tolerance=0.05, seed=7) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise |w|^2 / 2 + cost * sum of hinge losses."""
    n, dim = len(y), int(indices.max(initial=0)) + 1
    w, bias, alpha = np.zeros(dim), 0.0, np.zeros(n)
    square = np.array([np.dot(values[a:b], values[a:b]) for a, b in zip(indptr, indptr[1:])]) + 1.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(n):
            at, x = indices[indptr[i] : indptr[i + 1]], values[indptr[i] : indptr[i + 1]]
            gradient = y[i] * (np.dot(w[at], x) + bias) - 1.0
            step = min(max(alpha[i] - gradient / square[i], 0.0), cost) - alpha[i]
            if step:
                worst = max(worst, abs(step) * square[i])
                alpha[i] += step
                w[at] += step * y[i] * x
                bias += step * y[i]
        if worst < tolerance:
            break
    return w, bias


def _logistic(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability of y = 1, by Newton steps with a small ridge."""
    slope, shift = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)], 1)
    beta = np.array([slope, shift])
    target = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y <= 0).sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def _counts(buckets: np.ndarray) -> np.ndarray:
    """How often each bucket occurs; a part at a time, because numpy widens what it counts."""
    counts = np.zeros(1 << BITS, np.int64)
    for a in range(0, len(buckets), 1 << BITS):
        counts += np.bincount(buckets[a : a + (1 << BITS)], minlength=1 << BITS)
    return counts


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float, smoothing: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights by bucket and intercept, on the scale of log odds. ``share``: of label 1 among all labels. Empties ``rows``."""
    y = np.where(labels > 0, 1.0, -1.0)
    if not len(y) or y.min() == y.max():
        return np.zeros(0, np.float32), float(np.log(share / (1 - share)))
    # Rows to fit on come first, those of label 1 before the others; one row in four is kept out for the curve.
    kept_out = np.arange(len(y)) % 4 == 3
    order = np.lexsort((-y, kept_out))
    y, kept_out = y[order], kept_out[order]
    sizes = np.array([len(rows[i]) for i in order])
    indices = np.concatenate([rows[i] for i in order])
    rows.clear()
    usual = _counts(indices) >= 3
    kept = usual[indices]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.concatenate([[0], np.cumsum([np.count_nonzero(kept[a:b]) for a, b in zip(bounds, bounds[1:])])])
    indices = indices[kept]
    n_pos, n_fit = int(((y > 0) & ~kept_out).sum()), int((~kept_out).sum())
    pos = smoothing + _counts(indices[: ends[n_pos]])
    neg = smoothing + _counts(indices[ends[n_pos] : ends[n_fit]])
    ratio = np.log(pos / (max(1, n_pos) + 2 * smoothing)) - np.log(neg / (max(1, n_fit - n_pos) + 2 * smoothing))

    values = ratio.astype(np.float32)[indices[: ends[n_fit]]]
    w, bias = dual_coordinate_descent(ends[: n_fit + 1], indices[: ends[n_fit]], values, y[:n_fit], cost=0.1)
    w = np.pad(w, (0, (1 << BITS) - len(w))) * ratio
    margins = np.array([w[indices[a:b]].sum() for a, b in zip(ends, ends[1:])]) + bias
    check = kept_out if len({*y[kept_out]}) == 2 else np.ones_like(kept_out)
    weight = np.where(y > 0, share / max(1, (y[check] > 0).sum()), (1 - share) / max(1, (y[check] < 0).sum())) * check.sum()
    slope, shift = _logistic(margins[check], y[check], weight[check])
    slope = max(slope, 1e-3)
    return (w * slope).astype(np.float32), bias * slope + shift


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Weights by bucket, broadcast, and the intercept."""

    def __init__(self, weights: Broadcast, bias: float, grams: Grams):
        self.weights, self.bias, self.grams = weights, bias, grams

    def score(self, text: Column) -> Column:
        """Probability of label 1 for a column of texts."""
        weights, bias, grams = self.weights, self.bias, self.grams

        @F.pandas_udf("double")
        def probability(texts: pd.Series) -> pd.Series:
            w = weights.value
            margins = np.array([w[grams(t or b"")].sum(dtype=np.float64) if len(w) else 0.0 for t in texts])
            return pd.Series(1 / (1 + np.exp(-np.clip(margins + bias, -500, 500))))

        return probability(text.cast("binary"))


def fit_texts(docs: DataFrame, labels: DataFrame, label: str, grams: Grams, per_class: int = PER_CLASS) -> Model:
    """The model of ``label``, fitted at once on labelled texts (see above)."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["one"]: r["count"] for r in known.groupBy((F.col("label") > 0).alias("one")).count().collect()}
    share = (counts.get(True, 0) + 1) / (sum(counts.values()) + 2)

    drawn = None
    for one in (True, False):
        part = known.filter((F.col("label") > 0) == one).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        drawn = part if drawn is None else drawn.union(part)
    texts = narrow.join(F.broadcast(drawn), "doc_id")  # at most 2 * per_class rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("grams", pa.binary())])
        for batch in batches:
            ids, ones, text = (batch.column(n) for n in ("doc_id", "label", "text"))
            yield as_batch(schema, [ids, ones, [grams(t.as_py() or b"").tobytes() for t in text]])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ones = [], []
        for batch in batches:
            rows += [np.frombuffer(g.as_py(), np.int32) for g in batch.column("grams")]
            ones += batch.column("label").to_pylist()
        weights, intercept = fit(rows, np.array(ones, np.int64), share)
        yield as_batch(pa.schema([("weights", pa.binary()), ("bias", pa.float64())]), [[weights.tobytes()], [intercept]])

    bounded = texts.mapInArrow(extract, "doc_id long, label int, grams binary").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "grams")
    model = bounded.mapInArrow(learn, "weights binary, bias double").first()
    weights, bias = (np.frombuffer(model["weights"], np.float32), model["bias"]) if model else fit([], np.empty(0), share)
    return Model(spark.sparkContext.broadcast(weights), bias, grams)


def score_texts(docs: DataFrame, labels: DataFrame, label: str, grams: Grams, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score): the probability that ``label`` is 1, for every whole text.

    Fits the model at once; scoring is lazy.
    """
    model = fit_texts(docs, labels, label, grams, per_class)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), model.score(F.col("text")).alias("score"))
