"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.common import join_counted, stored


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node that it reaches, of every node with an edge.

    ``edges`` has two columns of numbers, in any direction, repeated or not; loops and nulls
    are ignored. Alternating star steps: first all larger neighbours of a node are moved to
    the smallest node around it, then all smaller ones, until every node has one edge, to its
    root. Edges of nodes with very many are joined by broadcast, so that no task has them all. Each
    round is stored; only the number and a hash of the edges reach the driver.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    state = None
    current = stored(current.where("u <> v").distinct(), "edges")
    while True:
        both = current.union(current.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("times"))
        lowest = stored(lowest.select("u", F.least("u", "m").alias("m"), "times"), "lowest")
        large = (
            join_counted(both, lowest, "u", "times")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stored(large, "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("times"))
        ends = F.explode(F.array("u", "v")).alias("u")
        small = (
            join_counted(large, stored(lowest, "lowest"), "u", "times")
            .select(ends, F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        current = stored(small, "edges")
        hashed = F.bit_xor(F.xxhash64("u", "v"))
        now = tuple(current.agg(F.count(F.lit(1)), hashed, F.countDistinct("u")).first())
        # Stars: one edge per node, and nothing moved.
        if now == state:
            break
        state = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
