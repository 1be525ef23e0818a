"""Connected components of an edge table by alternating star contraction.

Each round hooks every node to the smallest node it sees (large star: the
neighbours above it; small star: those below) until the edges are stars.  All
work is joins and map-side combined minima; edges are 16 bytes wide, each
round is written to the shared folder, and the rounds grow with the logarithm
of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.runtime import saved

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of any comparable type -> (node, root), root the smallest
    node of the component.  Nodes without an edge to another are not listed;
    loops, repeated edges and null ends are ignored; no edges give no rows."""
    e = (edges.select("u", "v").filter("u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = saved(spark, e, "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        e = saved(spark, _small_star(_large_star(e)), "edges")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
        if mark == now:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components: no fixed point after {MAX_ROUNDS} rounds")
