"""Connected components of a graph of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgrain.llm.common import materialize


def connected_components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """node, label (the least node of its component) for links (a, b); nodes without links are not listed.

    A round takes the least label of the neighbours (summed up before the shuffle, so a node with many links is no hot
    spot) and then the label of that label, which halves long paths. Each round is written to the shared folder.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "cc-links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "cc-labels")
    for _ in range(rounds):
        offered = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("offer"))
        lower = labels.join(offered, labels["node"] == offered["a"], "left").select("node", "label", F.least("label", "offer").alias("next"))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        new = lower.join(jump, lower["next"] == F.col("_n"), "left").select("node", F.least("next", "_l").alias("label"), (F.least("next", "_l") < F.col("label")).alias("moved"))
        new = materialize(new, "cc-labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
