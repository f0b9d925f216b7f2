"""Connected classes of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuary.session import cut_lineage


def components(pairs: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected set, by spreading smallest labels until nothing moves."""
    both = cut_lineage(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("label"))
    labels = cut_lineage(labels)
    while True:
        seen = both.join(labels, both["y"] == labels["node"]).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        own = labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("near"))
        # The label's own label is a shortcut along long chains.
        jump = own.alias("a").join(own.alias("b"), F.col("a.near") == F.col("b.node"), "left")
        nxt = cut_lineage(jump.select(F.col("a.node").alias("node"), F.least("a.near", F.coalesce("b.near", "a.near")).alias("label"), F.col("a.label").alias("old")))
        labels = nxt.select("node", "label")
        if not nxt.where("label <> old").take(1):
            return labels
