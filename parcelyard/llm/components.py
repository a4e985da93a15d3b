"""Connected components of a table of links, by alternating large-star and small-star.

Each round is a fixed number of joins and aggregates over the links; a node with many
links is folded before the shuffle, and the joins are of a shape that adaptive
execution can split. Nothing comes to the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.workspace import Workspace


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the least of the node's neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    return (
        both.where("b > a")
        .join(least, F.col("a") == F.col("node"))
        .select(F.col("b").alias("a"), F.least("node", "least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the least of these; links point down."""
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    below = (
        links.join(least, F.col("a") == F.col("node"))
        .where(F.col("b") > F.col("least"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return below.union(least).distinct()


def components(work: Workspace, links: DataFrame, name: str) -> DataFrame:
    """``node, component`` of every node with a link; a component is named by its least node.

    ``links`` has long columns a and b; order, repeats, loops and nulls do not matter.
    """
    down = links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    state, mark, turn = work.write(down.distinct(), f"{name}-0"), None, 0
    while True:
        seen = state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            break
        mark, turn = seen, turn + 1
        state = work.write(_small_star(_large_star(state)), f"{name}-{turn}")
        work.drop(f"{name}-{turn - 1}")
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
