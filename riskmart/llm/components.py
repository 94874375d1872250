"""Connected components of links, by taking the smallest neighbouring label and jumping along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.sources.scratch import Staging


def components(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by its smallest node.

    Each round writes its labels. Aggregates have partial sums, so a node with very many links is no burden.
    The number of rounds grows with the logarithm of a component's width.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staging.table(both.filter("a != b").distinct(), f"{name}-edges")
    labels = staging.table(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        seen = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("next"))
        # A node takes the label of its label as well.
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        moved = hooked.join(ahead, "next", "left").select("node", "label", F.least("next", "jump").alias("next"))
        moved = staging.table(moved, f"{name}-{step}")
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.filter("next < label").isEmpty():
            return labels.withColumnRenamed("label", "component")
