"""Connected components of links between 64-bit values, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinestrata.session import checkpointed


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the least of the node's neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), "m")
            .union(least).toDF("a", "b").distinct())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (a, b): the least node it is linked to.

    Links to itself are left out. Each round is cut by a checkpoint in the shared folder; the
    number of rounds grows with the logarithm of the longest chain. No neighbourhood is
    gathered: least neighbours come from aggregates, and the joins may be split by AQE.
    """
    now = checkpointed(links.where("a <> b").select("a", "b").distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                        ).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        now = checkpointed(_small_star(_large_star(now)))
