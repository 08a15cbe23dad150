"""Connected components of an edge table by alternating large-star and small-star.

Each round rewires edges to smaller neighbours, so chains shrink geometrically
and a component ends as a star around its smallest node; tables that are stars
already take no round. Minima are aggregated map-side and written before they
are joined back, so adaptive execution can split the join of a node with very
many edges. Only the answer whether all are stars reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _all_stars(edges: DataFrame) -> bool:
    """Whether every larger node has one edge and no node is both ends of edges."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where("up + down > 1").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is the smallest
    node of its component. Self-loops and repeated edges do no harm."""
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = scratch.write(edges.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct(), "edges-0")
    step = 0
    while not _all_stars(edges):
        step += 1
        # Large star: every larger neighbour of a node moves to the node's minimum.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = scratch.write(least.select("a", F.least("a", "m").alias("m")), f"least-{step}")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.write(large, f"large-{step}")
        # Small star: a node's smaller neighbours move to their minimum too.
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")), f"small-least-{step}")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = scratch.write(least.select("a", F.col("m").alias("b")).unionByName(moved).distinct(), f"edges-{step}")
    hubs = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(hubs.select(F.col("b").alias("node"), F.col("b").alias("label")))
