"""Connected components of an edge table by alternating stars, and cohesion of the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import written


def components(edges: DataFrame, a: str = "a", b: str = "b", *, max_rounds: int = 60) -> DataFrame:
    """node, component (its least node) for every node that has an edge.

    Large-star and small-star steps in turn connect each node to the least node it knows; the number of
    rounds grows with the logarithm of the graph's diameter, not with the diameter. A round is two partial
    minima and two equi-joins on the node, so a hub costs one partial row per task and AQE splits its joins;
    neighbours are never collected. Every round ends in a table in the shared folder. A graph that is not
    settled after ``max_rounds`` rounds (the last one must find nothing to move) is an error.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u")
        nxt = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).distinct()
        e = written(nxt, "edges")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1_000_000_007)), F.sum(F.xxhash64("v", "u") % F.lit(998_244_353))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components are not settled after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
