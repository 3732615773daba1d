"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for each node of `links` (a, b) but the roots; the root is the smallest node.

    Every round is a table in the shared folder. Rounds grow with the logarithm of the longest path.
    """
    links = stored(links.where("a <> b").distinct(), "links")
    while True:
        after = stored(_small_star(_large_star(links)), "links")
        same = after.count() == links.count() and after.exceptAll(links).isEmpty()
        links = after
        if same:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
