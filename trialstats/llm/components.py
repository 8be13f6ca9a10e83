"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialstats.llm.common import settle


def _stars(edges: DataFrame) -> DataFrame:
    """Hang every neighbour above a node on the least node of its neighbourhood, then those below."""
    both = edges.union(edges.selectExpr("b AS a", "a AS b"))
    # Written by itself, so that the join is not tied to the shuffle of the aggregate and a hub can be split.
    least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    large = settle(both.join(least, "a").where("b > a").selectExpr("b AS a", "m AS b").where("a <> b").distinct())
    # Edges now point down; the least of the lower neighbours takes over the others and the node.
    lower = settle(large.groupBy("a").agg(F.min("b").alias("m")))
    return large.join(lower, "a").selectExpr("IF(b = m, a, b) AS a", "m AS b").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of the edges ``(a, b)``: the component is its least node.

    Rounds run until the edges stay the same, which takes about the logarithm of the longest
    path; each is written to the shared folder. A node with many edges is combined before the
    shuffle for its minimum, and its join is split by adaptive execution. Nodes may be of any type
    that has an order; loops and null ends are left out.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    edges = settle(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct())
    before = mark(edges)
    while before[0]:
        edges = settle(_stars(edges))
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.selectExpr("a AS node", "b AS component").union(edges.selectExpr("b", "b").distinct())
