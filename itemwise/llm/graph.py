"""Connected components of links between 64-bit nodes, as rounds of Spark
joins (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.session import write_scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node; combined map-side, so a node with
    very many links costs one row a task."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of ``links``; root is the least node that
    can be reached.  No links give no rows; loops and repeats do no harm."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = write_scratch(edges, "links")
    seen = None
    while True:
        # Large star: every larger neighbour moves to the least one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        moved = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: every smaller neighbour, and the node, move to the least one.
        moved = moved.where("u > v").distinct()
        low = _least(moved)
        moved = (moved.join(low, "u")
                 .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u > v").distinct())
        edges = write_scratch(moved, "links")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
