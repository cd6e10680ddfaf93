"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmetrics.llm.batches import SharedFolder


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it instead."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    own = least.select("a", F.col("m").alias("b"))
    others = joined.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.union(others)


def components(links: DataFrame, folder: SharedFolder, name: str) -> DataFrame:
    """(node, root) of every node that has a link to another one; the root is the least node.

    ``links`` has two columns of one type; null ends and links to itself do not count. Each round
    is written to the shared folder. Rounds grow with the logarithm of the longest chain.
    """
    a, b = links.columns
    links = links.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("a > b")
    links = folder.table(links.distinct(), f"{name}-0")
    mark, step = None, 0
    while True:
        step += 1
        links = folder.table(_small_star(_large_star(links).distinct()).distinct(), f"{name}-{step}")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark = now
    root = links.groupBy("b").agg(F.count("*").alias("n")).select(
        F.col("b").alias("node"), F.col("b").alias("root")
    )
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(root)
