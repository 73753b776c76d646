"""Connected components of a graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: one node of its component for all of them.

    Each round every node hooks onto its smallest neighbour, and the edges are drawn anew between what the
    nodes hooked onto, twice over; edges inside a component vanish, so the graph shrinks by a constant factor for
    nodes named by hashes. Rounds are stored; only whether edges are left reaches the driver.
    """
    both = edges.where("a <> b").select("a", "b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    while not both.isEmpty():
        near = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("hook"))
        near = stored(near, "hooks")
        over = near.select(F.col("node").alias("hook"), F.col("hook").alias("next"))
        near = stored(near.join(over, "hook").select("node", F.col("next").alias("hook")), "hooks")
        labels = stored(
            labels.alias("l").join(near.alias("n"), F.expr("l.root = n.node"), "left").select("l.node", F.expr("coalesce(n.hook, l.root)").alias("root")), "roots"
        )
        first = both.join(near.select(F.col("node").alias("a"), F.col("hook").alias("x")), "a").select("x", "b")
        second = first.join(near.select(F.col("node").alias("b"), F.col("hook").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        both = stored(second.where("a <> b").distinct(), "edges")
    return labels
