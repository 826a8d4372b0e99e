"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.runtime import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of a link; label is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so chains shrink by
    doubling. Rounds are cut by checkpoints and end when none changes. A node with very many links is one side of a join
    whose other side is unique, which Spark splits, and its links are pre-aggregated before they are shuffled.
    NULL ends of links and links of a node to itself say nothing and are left out.
    """
    one = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    both = cut(one.union(one.select("other", "node")).distinct())
    labels = cut(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        best = both.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("m"))
        hooked = cut(
            labels.join(best, "node").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        )
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = cut(
            hooked.join(above, "label", "left").select(
                "node", F.coalesce("above", "label").alias("label"), (F.coalesce("above", "label") != F.col("was")).alias("moved")
            )
        )
        moved = labels.filter("moved").limit(1).count()
        labels = labels.drop("moved")
        if not moved:
            return labels
