"""Connected components by minimum labels with shortcuts, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import discard, stash


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, label), label the smallest node of the component; only nodes with an edge.

    Each round takes the smallest label among the neighbours and then the label's own label, so
    the rounds grow with the logarithm of the longest chain. A hub is pre-aggregated by map-side minimum.
    """
    links = stash(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stash(links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("low"))
        lower = stash(labels.join(near, labels.node == near.a).select("node", F.least("label", "low").alias("label"), F.col("label").alias("was")), "labels")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = stash(lower.join(up, "label").select("node", F.least("label", "top").alias("label"), "was"), "labels")
        discard(labels, lower)
        labels = new.drop("was")
        labels._stashed = new._stashed
        if new.filter("label <> was").isEmpty():
            discard(links)
            return labels
