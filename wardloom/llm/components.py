"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardloom.llm.common import written


def _stars(links: DataFrame) -> DataFrame:
    """Links (a, b) with b < a, each once."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the root is the smallest node of its component.

    A large star links the greater neighbours of a node to its least one, a small star the lesser ones; both keep components and shorten
    paths, and after a number of rounds that grows with the logarithm of the longest path every node hangs on its root. Least
    neighbours are found by pre-aggregation, so a node with many links is no hot spot.
    """
    now = written(_stars(links), "links")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        mid = written(_stars(large), "large-star")
        down = mid.groupBy("a").agg(F.min("b").alias("m"))
        small = mid.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        now = written(_stars(small), "small-star")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.col("a").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
