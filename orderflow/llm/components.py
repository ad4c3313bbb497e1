"""Connected components of an edge table by alternating large-star and
small-star steps, each a grouped minimum joined back to the edges.

No group is collected: a hub's edges are aggregated before the shuffle and
the join back may be split by AQE. Every round is written to the checkpoint
folder, so the plan stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    low = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return near.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = _down(edges)
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    to_low = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_low.unionByName(low.select("a", F.col("m").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge to its root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    role = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return role.where("down > 1 or down = 1 and up = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` to ``(node, root)`` for every node that is not its own
    root; ``root`` is the smallest node reachable. Self loops and null ends are
    ignored; an empty edge table gives an empty result."""
    current = stage(_down(edges).distinct(), "edges")
    while not _settled(current):
        current = stage(_small_star(_large_star(current)).where("a <> b").distinct(), "edges")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
