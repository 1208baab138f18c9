"""Connected components of an edge table by alternating large-star and small-star steps.

Edges stay distributed; every round is cut by a checkpoint in the shared folder,
and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlab.llm.common import keep


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("s")).collect()[0]
    return r["n"], r["s"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the least node of its component."""
    e = keep(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct())
    before = _mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # every greater neighbour of a node points to the least node around it
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        # every lesser neighbour, and the node itself, point to the least of them
        small = large.join(least, "b")
        e = keep(small.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b")
                 .unionByName(small.select(F.col("m").alias("a"), "b")).distinct())
        after = _mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
