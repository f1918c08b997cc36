"""Connected components of links, held in tables throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def components(links: DataFrame) -> DataFrame:
    """``doc``, ``component`` (the smallest reachable document) for all documents in
    ``links`` (``a``, ``b``).

    Every round takes the smallest label among the neighbours, reduced per task before
    the shuffle, and then the label of that label; each is written to the shared folder,
    so a lost executor costs no more than its part of a round.
    """
    edges = materialise(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("doc")).agg(
        F.min("b").alias("b")).select("doc", F.least("doc", "b").alias("component")), "labels")
    while True:
        near = edges.join(labels.select(F.col("doc").alias("b"), F.col("component").alias("near")), "b") \
            .groupBy(F.col("a").alias("doc")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "doc").select(
            "doc", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("doc").alias("component"), F.col("component").alias("jump"))
        new = materialise(lower.join(jump, "component", "left").select(
            "doc", "old", F.least("component", F.coalesce("jump", "component")).alias("component")), "labels")
        labels = new.select("doc", "component")
        if new.where(F.col("old") != F.col("component")).isEmpty():
            return labels
