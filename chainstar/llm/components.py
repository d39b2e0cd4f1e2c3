"""Connected components of a link table, by alternating star contractions.

Large-star joins every larger neighbour of a node to the least node around it,
small-star does so with the smaller neighbours; both keep components, and the
rounds end when nothing changes (each node points at the least node of its
component).  A node's least neighbour is a partial aggregate, so a hub with a
third of all links is no hot group; joining it back is a skew join that AQE splits.
Each round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainstar.llm.common import written


def _star(both: DataFrame) -> DataFrame:
    """(u, v, m): links of u with the least node m among u and its neighbours v."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _star(both).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    # a < b: the smaller neighbours of u = b.
    both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    linked = _star(both)
    out = linked.filter("v != m").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
        linked.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.filter("a != b").distinct()


def components(links: DataFrame, path: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a < b), root the least node of its component."""
    edges, seen, n = links.select("a", "b"), None, 0
    while True:
        edges = written(_small(_large(edges)), f"{path}/{n}")
        # One number for the whole table: equal tables of two rounds end the loop.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen, n = now, n + 1
    member = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return member.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
