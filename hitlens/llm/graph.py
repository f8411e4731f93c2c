"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlens.llm.common import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with the least of v and u over all edges of u as ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    large = _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Every edge now points to a smaller node: u > v.
    starred = _least_neighbour(large)
    small = starred.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(starred.select("u", F.col("m").alias("v")))
    return small.where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches.

    Edges between equal nodes and repeats don't matter; nodes must not be
    null. Every round is written to the shared folder; the least neighbours
    are map-side combined, so a hub's edges never meet in one task. Rounds
    grow with the logarithm of the largest component.
    """
    a, b = F.col(u), F.col(v)
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        after = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if after == mark or not after.n:
            break
        mark = after
        now = stored(_round(now), "edges")
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
