"""Connected components of a graph whose edges and nodes stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node and component, its smallest node, for all nodes of `edges` (bigint columns u and v).

    Each round gives a node the smallest label among its own and its neighbours', and then the label
    of the node that its label names, so that labels double their reach. Rounds are written to the
    shared folder. A node with many edges is summed up in each task first, and its join is split by
    adaptive execution. An empty table gives no rows.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = stored(both.distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("component")),
        "labels",
    )
    while True:
        heard = both.join(labels, F.col("u") == F.col("node")).select(
            F.col("v").alias("node"), "component"
        )
        least = heard.unionByName(labels).groupBy("node").agg(F.min("component").alias("component"))
        named = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = least.join(named, "component").select(
            "node", F.least("component", "further").alias("component")
        )
        after = stored(after, "labels")
        before = labels.select("node", F.col("component").alias("old"))
        changed = after.join(before, "node").filter("component <> old").limit(1).count()
        labels = after
        if not changed:
            return labels
