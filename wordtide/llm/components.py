"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    out = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return out.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the smallest of them. Here u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``links``: a, b; order, repetition, and a link of a node with itself do not matter. A null end
    makes no link. A node's links are never gathered in one place: a round is two grouped minima and
    two joins, and is written to the shared folder before the next. Rounds end when a round changes
    no edge; their number grows with the logarithm of a component's size.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    seen = None
    while True:
        mark = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        edges = written(_small_star(_large_star(edges)), "stars")
