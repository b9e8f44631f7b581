"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendmart.sources.snapshots import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label): every node of ``links`` (a, b) with the smallest node reachable.

    Every round, a node takes the smallest label around it and then its label's label, so
    stars and paths both shrink quickly. Labels of a node are combined before the shuffle.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(
            F.min("label").alias("near"))
        nearer = stage(labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(nearer.join(jump, "label", "left").select(
            "node", "old", F.least("label", "next").alias("label")))
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
