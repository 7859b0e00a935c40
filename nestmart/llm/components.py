"""Connected components by alternating large-star and small-star rounds.

Every round is joins and map-side combined minima; nothing is gathered per
node, and each round's edges are written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u > v).  Large star: links of a node to larger neighbours move
    to its least neighbour; small star: links to smaller ones do."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("w"))
    least = least.select("u", F.least("u", "w").alias("w"))
    if large:
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v"))
    else:
        moved = both.join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).unionAll(least.select("u", F.col("w").alias("v")))
    return moved.where("u > v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    down = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    up = edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    nodes = down.unionAll(up).groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b) that is not
    its own root; root is the least node of its component."""
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    while not _settled(now):
        now = stored(_stars(_stars(now, True), False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
