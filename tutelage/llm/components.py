"""Connected components of a link table by alternating stars, all in joins and aggregates.

A round links every neighbour of a node that is larger than it, then every one that is smaller, to the node's
least neighbour. Rounds are few (logarithmic in the number of nodes), each is written to the shared
folder, and hubs are left to adaptive skew splitting: no neighbour list is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutelage.llm.frames import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (``a``, ``b``: two columns of one integer type) but the roots; a root is its component's least node.

    Null ends and links of a node to itself are left out; repeated links change nothing.
    """
    links = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    state = None
    while True:
        mark = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == mark or mark["n"] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = mark
        links = materialise(_small_star(_large_star(links).distinct()).distinct(), "links")
