"""Connected components of a distributed edge table.

Alternating star contraction: large-star hangs each neighbour above a node on
the smallest neighbour, small-star does so for the neighbours below. Both are
a grouped minimum (combined before the shuffle) and a join on the node, whose
hot nodes are split by AQE. Each round is written to the shared folder, so a
lost executor repeats tasks of one round only. Nothing but row counts
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import dropped, saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    up = both.where(F.col("v") > F.col("u"))
    return up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, root`` for every node with an edge but the root itself; ``root``
    is the smallest node that can be reached. ``edges``: ``u, v`` longs."""
    spark = edges.sparkSession
    now, path = saved(edges.where("u != v").select("u", "v").distinct(), "cc")
    size = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
    while True:
        step, step_path = saved(_small_star(_large_star(now)), "cc")
        then = step.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
        dropped(spark, path)
        now, path = step, step_path
        if then == size:
            return now.select("u", F.col("v").alias("root"))
        size = then
