"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stash import Stash


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, stash: Stash) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (a, b) but the least of its component.

    ``component`` is the least node reachable. Each round writes its links, so a round
    depends on the one before only; a link table shrinks to stars in a few rounds, and no
    task holds the links of a node.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = stash.put(ordered.filter("a > b").distinct(), "links"), None
    while True:
        mark = links.select(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if mark["n"] == 0 or mark == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, links = mark, stash.put(_small_star(_large_star(links)), "links")
