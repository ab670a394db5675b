"""Connected components by alternating large and small stars (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each node has one parent and no parent has a parent."""
    up = edges.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("w"))
    deep = up.join(up.select(F.col("u").alias("v")), "v", "left_semi").limit(1)
    return up.filter("v <> w").limit(1).unionByName(deep.select("u", "v", "w")).isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; a component is its smallest node.

    No node's neighbours are ever gathered: each round takes minima (combined before the
    shuffle) and joins them back; a join on a hub reads two numbers a neighbour in one task.
    """
    flat = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    flat = scratch.table(flat, "edges")
    for _ in range(most_rounds):
        if _is_forest_of_stars(flat):
            tree = flat.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = flat.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return tree.unionByName(roots)
        both = flat.unionByName(flat.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        flat, old = scratch.table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges"), flat
        scratch.drop(old)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
