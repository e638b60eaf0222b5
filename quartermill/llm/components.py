"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the component's least node) of every node of the edges ``a``, ``b``.

    Alternates two star steps until nothing changes: every node's larger neighbours
    are hung on its least neighbour, then its smaller ones and itself. The number of
    edges never grows beyond twice the input's, and a hub's edges are spread by an
    adaptive join, not gathered. Loops, repeated edges and an empty table are fine.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, mark = cut(ordered.filter("a <> b").distinct()), None
    while True:
        seen = now.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            break
        mark = seen
        now = cut(small_star(large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node, hung on the least of it and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, hung on the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", "m")).distinct()
