"""Connected components by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrolake.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected `edges` (a, b); component is its smallest node.

    Each round takes the smallest label among the neighbours, then the label's own label, which halves the way to the
    smallest node. Minima are combined before the shuffle, and joins on a hot node or label have no aggregate above
    them that needs a node's rows together, so Spark may split them. Rounds are written to the shared folder.
    """
    both = edges.select("a", "b").where("a <> b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a <> b").distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
    labels = written(labels, "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        closer = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        closer = written(closer, "closer")
        targets = closer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        stepped = closer.join(targets, "label").select("node", "old", F.col("next").alias("label"))
        stepped = written(stepped, "labels")
        done = stepped.where("old <> label").isEmpty()
        labels = stepped.select("node", "label")
        if done:
            return labels.withColumnRenamed("label", "component")
