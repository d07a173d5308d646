"""Connected components of links, as joins and aggregations that never leave Spark."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, class) for every node of ``links`` (a, b: long); the class is the smallest node that it is linked with.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so labels
    travel twice as far every round.  Rounds are stored; the loop ends when no label changes.  Neighbours are
    pre-aggregated before they are shuffled, so a node with very many links is no heavier than others.
    """
    both = stored(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
                  .union(links.select("b", "a")).where("src <> dst").distinct(), "links")
    labels = stored(both.groupBy("src").agg(F.min("dst").alias("low"))
                    .select(F.col("src").alias("node"), F.least("src", "low").alias("class")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("dst"), "class"), "dst")
                .groupBy("src").agg(F.min("class").alias("low")))
        lower = (labels.join(near, labels["node"] == near["src"])
                 .select("node", F.least("class", "low").alias("class"), F.col("class").alias("was")))
        jump = labels.select(F.col("node").alias("of"), F.col("class").alias("further"))
        following = stored(lower.join(jump, F.col("class") == F.col("of"), "left")
                           .select("node", F.least("class", F.coalesce("further", "class")).alias("class"), "was"), "labels")
        labels = following.select("node", "class")
        if following.where(F.col("class") != F.col("was")).isEmpty():
            return labels
