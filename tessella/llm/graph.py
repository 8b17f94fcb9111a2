"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.shared import cut


def _to_least(pairs: DataFrame, both_ways: bool) -> DataFrame:
    """Link each node's neighbours to the least of node and neighbours.

    With ``both_ways`` (large star) only larger neighbours are linked; without (small star) pairs
    point from node to smaller neighbour, and the node itself is linked as well.
    """
    around = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else pairs
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if both_ways:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return linked.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``); root is the least node reached.

    Each round writes its edges to the shared folder; the number of rounds grows with the
    logarithm of the largest component, and a few bytes a round reach the driver.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        now = cut(_to_least(_to_least(now, True), False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
