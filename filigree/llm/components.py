"""Connected components of a table of links, by alternating stars.

Every round is two joins on narrow rows. A node with very many links is one key of a
plain equi-join, which adaptive execution splits, and of a ``min`` that is merged
before the shuffle; no neighbour list is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.work import restored, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie each node's neighbours to the smallest of them and itself: the larger
    neighbours (``larger``), or itself and the smaller ones."""
    if larger:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        ).select("e.a", F.col("e.m").alias("b"))
    return out.where("a != b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link; ``component`` is the
    smallest node reachable. Links are undirected and may repeat; a link of a node to
    itself or to NULL is no link. Empty input gives an empty result."""
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = stored(edges, "links")
    before = _state(edges)
    while before[0]:
        edges = restored(_stars(_stars(edges, True), False), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
