"""Connected components of an edge table, by alternating star contraction.

Every step is a grouped minimum and a join; nothing is collected. A hub's edges
are pre-aggregated before the shuffle (minimum per node), and the join back is
one that Spark splits when a hub is skewed. Each round is written to the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.llm.common import written


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))
        ).first()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b.

    Large: every neighbour above a node is moved to the least of the node's
    neighbourhood. Small: every neighbour not above it is, and the node itself.
    """
    if large:
        seen = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select("a", "b")
    least = seen.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    moved = seen.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # a node's own edge to its least neighbour stays
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            least.select("a", F.col("low").alias("b"))
        )
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b); component is its least node."""
    edges = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        edges = written(_star(_star(edges, large=True), large=False), "edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
