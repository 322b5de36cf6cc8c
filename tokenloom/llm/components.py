"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import drop_staged, staged


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b`` links; the component is its smallest node.

    Each round a node takes the smallest label among its neighbours', and then its label's label, so that
    chains halve. Labels are written between rounds, nothing but a count reaches the driver. A hub's links
    are pre-aggregated before they meet. No links give an empty table, null ends are left out.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a IS NOT NULL AND b IS NOT NULL")
    both = staged(both.distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("nearest"))
        better = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("before"), F.least("component", "nearest").alias("component")
        )
        onward = better.select(F.col("node").alias("at"), F.col("component").alias("further"))
        jumped = better.join(onward, F.col("component") == F.col("at"), "left").select(
            "node", "before", F.coalesce("further", "component").alias("component")
        )
        after = staged(jumped, "labels")
        moved = after.filter("component < before").limit(1).count()
        drop_staged(labels)
        labels = after
        if not moved:
            drop_staged(both)
            return labels.select("node", "component")
