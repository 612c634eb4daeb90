"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm import base


def state(edges: DataFrame) -> tuple:
    """Number of edges and two sums over them: equal for equal sets of edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.bitwiseAND(0x7FFFFFFF)), F.sum(F.shiftrightunsigned(h, 33))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node of its component.

    Each round points every node at the smallest node seen near it, first from
    above, then from below; groups are reduced by a minimum before they are
    joined again, so a node of very many links makes no large group. The edges of
    a round are kept in the shared folder. Rounds grow with the logarithm of the
    longest chain.
    """
    edges = base.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while (now := state(edges)) != before:
        before = now
        # large star: neighbours above a node go to the smallest around it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: neighbours below a node, and itself, go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = base.keep(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    nodes = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return base.keep(nodes.unionByName(roots))
