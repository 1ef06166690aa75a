"""Connected components of a large edge list, without a driver-side graph.

Alternates the large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014), which need a logarithmic number of rounds on long chains too.
Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, both.u == least.w).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    near = down.join(least, down.u == least.w).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges: (u long, v long), any direction, repeats allowed. Returns (node, root): each node with an edge to another
    but the smallest of its component, and that smallest node. No edges: no rows."""
    e = stage(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        e = stage(_small_star(_large_star(e)), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
