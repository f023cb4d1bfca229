"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut


def _large_star(links: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the component's least node.

    O(log n) rounds, each cut through the shared folder; a hub's rows are joined by a keyed shuffle
    whose large partitions AQE splits. No links: no rows.
    """
    now = cut(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = cut(_small_star(_large_star(now)).filter(F.col("a") != F.col("b")).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
