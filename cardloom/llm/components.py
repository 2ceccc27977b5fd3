"""Connected components of a graph given as pairs, by alternating star contraction.

Each round is two aggregates and joins over the pairs; the number of rounds grows with the
logarithm of the longest path, and pairs that are stars already take none. Nothing but one number
per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardloom.llm.common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node reachable.

    Links of a node to itself and repeated links are harmless. A node without links is absent.
    """
    pairs = stage(_ordered(links), "links")
    while not _stars(pairs):
        pairs = stage(_small_star(_large_star(pairs)), "links")
    return pairs.selectExpr("a AS node", "b AS root").union(pairs.selectExpr("b", "b").distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()


def _stars(pairs: DataFrame) -> bool:
    """Whether each node is tied to one smaller node at most, which is then tied to none: the least of its component."""
    ends = pairs.selectExpr("a", "b", "explode(array(a, b)) AS node").groupBy("node").agg(
        F.expr("count_if(node = a)").alias("up"), F.expr("count_if(node = b)").alias("down"))
    return ends.where("up > 1 OR up = 1 AND down > 0").count() == 0


def _large_star(pairs: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest node it knows; pairs may repeat."""
    both = pairs.union(pairs.selectExpr("b", "a"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    return both.join(least, F.col("a") == F.col("node")).where("b > a").selectExpr(
        "b AS a", "least(low, node) AS b")


def _small_star(pairs: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of these."""
    least = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    moved = pairs.join(least, F.col("a") == F.col("node")).where("b <> low").selectExpr("b AS a", "low AS b")
    return moved.union(least.selectExpr("node", "low")).distinct()
