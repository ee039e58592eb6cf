"""Toxicity of texts: a linear model over character n-grams scaled by naive Bayes log-count ratios.

See ``llm.nbsvm`` for the method, the bound on labelled rows and the defined cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.nbsvm import PER_CLASS, character_grams, fit_texts, score_texts

THRESHOLD = 0.3


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): predicted is 1 where the score of toxicity reaches ``threshold``."""
    scored = score_texts(docs, labels, "toxic", character_grams, per_class)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``threshold``, with all their columns. Fits at once, filters lazily."""
    model = fit_texts(docs, labels, "toxic", character_grams, per_class)
    return docs.filter(model.score(F.col("text")) < threshold)
