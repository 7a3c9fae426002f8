"""Checks of order and layout, which a comparison of row sets cannot see.

Each returns one row of counts that are zero where the layout holds. Rows are
compared with the row before them inside their partition (a window per
partition, never one over all rows); partitions are compared by their least
and greatest keys, one row for each partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_faults(df: DataFrame, *keys: Column) -> DataFrame:
    """``n_rows``; ``inversions``: rows with a key below that of the row before
    them in their partition; ``boundary_inversions``: partitions that end above
    the begin of the next one that has rows. Keys count ascending, nulls first."""
    placed = df.select(
        F.struct(*keys).alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")
    )
    before = F.lag("key").over(Window.partitionBy("part").orderBy("pos"))
    parts = placed.withColumn("before", before).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("key") < F.col("before")).alias("inversions"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
    )
    edges = F.array_sort(F.collect_list(F.struct("part", "low", "high")))
    total = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("inversions"), F.lit(0)).alias("inversions"),
        edges.alias("edges"),
    )
    faults = F.zip_with(
        "edges", F.slice("edges", 2, F.greatest(F.size("edges"), F.lit(1))),
        lambda a, b: F.coalesce(a["high"] > b["low"], F.lit(False)).cast("bigint"),
    )
    boundary = F.aggregate(faults, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return total.select("n_rows", "inversions", boundary.alias("boundary_inversions"))


def key_faults(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n_keys``; ``split_keys``: keys with rows in two or more partitions;
    ``partitions_over``: partitions with rows beyond the ``n`` asked for."""
    placed = df.select(F.col(key).alias("key"), F.spark_partition_id().alias("part"))
    keys = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    return keys.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("low") < F.col("high")).alias("split_keys"),
        F.count_if(F.col("high") >= n).alias("partitions_over"),
    )
