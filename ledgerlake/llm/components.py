"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Alternates large-star and small-star steps (every node hangs its neighbours on its smallest one), which
    ends after a number of rounds logarithmic in the longest path. Each step is a grouping by node whose
    minimum is reduced in the map tasks, and a join of edges with one row per node; the number of edges never
    grows beyond that of the input. No edge list reaches the driver.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u <> v").distinct()
    e = checkpointed(e)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        hung = small.select("u", F.explode(F.when(F.col("v") > F.col("m"), F.array("u", "v")).otherwise(F.array("u"))).alias("x"), "m")
        e = checkpointed(hung.select(F.col("x").alias("u"), F.col("m").alias("v")).distinct())
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
