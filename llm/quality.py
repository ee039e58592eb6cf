"""Quality of texts: naive Bayes support vectors over words and word shapes. See ``llm.nbsvm`` for method and cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.nbsvm import PER_CLASS, score_texts, word_grams

THRESHOLD = 0.7


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): predicted is 1 where the score of quality reaches ``threshold``."""
    scored = score_texts(docs, labels, "quality", word_grams, per_class)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
