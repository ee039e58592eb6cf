"""Connected components of a graph given as edges, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) can reach.

    A node takes the smallest label among its neighbours', then the label of its label,
    so the rounds grow with the logarithm of the longest path. Labels are written after
    every round; nothing but the count of changes reaches the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "graph")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "m").alias("low"))
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("jumped"))
        after = lower.join(jump, "low").select("node", F.least("low", "jumped").alias("label"), (F.least("low", "jumped") < F.col("label")).alias("changed"))
        after = stored(after, "labels")
        changed = after.filter("changed").head(1)
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
