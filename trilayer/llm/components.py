"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilayer.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """`links` has long columns a and b.  Result: node and `root`, the smallest node that it is connected to.

    Each round every node takes the smallest label among its own and its neighbours', then the label of its label; rounds
    end when no label changes.  Messages are reduced before they are shuffled, and labels and links are read from files,
    so the joins have plain exchanges below them and a node with very many links is split.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "root")
        lower = heard.unionByName(labels).groupBy("node").agg(F.min("root").alias("root"))
        lower = stored(lower)
        of_root = lower.select(F.col("node").alias("root"), F.col("root").alias("higher_root"))
        jumped = lower.join(of_root, "root").select("node", F.col("higher_root").alias("root"))
        before = labels.select("node", F.col("root").alias("old_root"))
        labels = stored(jumped.join(before, "node").select("node", "root", (F.col("root") < F.col("old_root")).alias("changed")))
        if not labels.where("changed").limit(1).count():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
