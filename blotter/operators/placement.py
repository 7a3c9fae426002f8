"""Rows sent to stated partitions: stored split points, and the line jobs' hash.

Split points. A bounded sample of the rows is drawn by a hash of the row's key
(the smallest hashes: each task keeps ``k`` rows and the tasks' rows are merged,
so memory does not depend on the input and every layout gives the same sample).
Its quantiles are the points; they are written to a file, read back, and each
row goes to the partition that a binary search over them names. A range of
several columns lets a hot first column span partitions.

Natural key. The line jobs place a key by ``hash & MAX % n`` with the hash of a
Java string. Here that is a column expression, and the rows go to the
partition it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.sources.delimited import MissingInputError, checked_read

#: The sampler's defaults: share of the rows, and most rows (the rate job's).
SAMPLE_SHARE = 0.01
SAMPLE_ROWS = 1000

_PLACES = 1 << 60


def bottom_k(df: DataFrame, row_key: Column, k: int = SAMPLE_ROWS, share: float = SAMPLE_SHARE) -> DataFrame:
    """At most ``k`` rows of ``df``: those with the smallest hashes of ``row_key``
    among the first ``share`` of all hashes."""
    place = F.conv(F.substring(F.md5(row_key), 1, 15), 16, 10).cast("bigint")
    drawn = df.select("*", place.alias("_place")).where(F.col("_place") < F.lit(int(share * _PLACES)))
    return drawn.orderBy("_place", *df.columns).limit(k).drop("_place")


def sample_points(sample: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """``point`` (from 0) and ``keys``: at most ``n - 1`` ascending split points for
    ``n`` partitions, from a bounded ``sample``. Partition ``i`` takes the keys
    above point ``i - 1`` up to point ``i``. Equal points are one, so a key with
    few values gives fewer partitions, none of them empty by design."""
    found = sample.agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("keys"))
    m = F.size("keys")
    at = F.when(m > 0, F.sequence(F.lit(1), F.lit(n - 1))).otherwise(F.array().cast("array<int>")) if n > 1 else F.array().cast("array<int>")
    points = F.transform(at, lambda i: F.element_at("keys", F.ceil(i * m / n).cast("int")))
    return found.select(F.posexplode(F.array_distinct(points)).alias("point", "key")).select("point", "key.*")


def write_points(points: DataFrame, path: str) -> None:
    """One small file of JSON lines (nulls stay nulls)."""
    points.coalesce(1).write.mode("overwrite").json(path)


def read_points(spark: SparkSession, path: str, keys: T.StructType) -> list[Row]:
    """The points of :func:`write_points` in order. There are fewer of them than
    partitions, so the driver holds them."""
    schema = T.StructType([T.StructField("point", T.IntegerType()), *keys])
    rows = checked_read(path, lambda p: spark.read.schema(schema).json(p)).orderBy("point").collect()
    points = [Row(**{f.name: r[f.name] for f in keys}) for r in rows]
    if [r["point"] for r in rows] != list(range(len(rows))):
        raise ValueError(f"{path}: not a file of split points")
    return points


def range_number(keys: T.StructType, points: list[Row]) -> Column:
    """The partition of a row: how many points lie below its keys, by a binary
    search over the points. Nulls are below all values."""
    key = F.struct(*[F.col(f.name) for f in keys])
    bounds = [F.struct(*[F.lit(p[f.name]).cast(f.dataType).alias(f.name) for f in keys]) for p in points]

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key <= bounds[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(points))


def partition_by_points(df: DataFrame, keys: tuple[str, ...], points: list[Row]) -> DataFrame:
    """``df`` over ``len(points) + 1`` partitions in a total order: partition ``i``
    holds the keys of range ``i``, sorted."""
    kinds = T.StructType([df.schema[k] for k in keys])
    placed = df.repartitionById(len(points) + 1, range_number(kinds, points))
    return placed.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])


def points_at(df: DataFrame, keys: tuple[str, ...], n: int, path: str) -> list[Row]:
    """The split points stored at ``path``; where there are none yet, those of a
    bounded sample of ``df`` (whose rows ``keys`` name) are stored there first."""
    spark = df.sparkSession
    kinds = T.StructType([df.schema[k] for k in keys])
    try:
        return read_points(spark, path, kinds)
    except MissingInputError:
        row_key = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        write_points(sample_points(bottom_k(df.select(*keys), row_key), keys, n), path)
        return read_points(spark, path, kinds)


def string_hash(c: Column) -> Column:
    """The line jobs' key hash without its sign: Java's string hash over UTF-16
    units, ``& MAX``. Null counts as the empty string."""
    units = F.hex(F.encode(F.coalesce(c, F.lit("")), "UTF-16BE"))
    at = F.when(F.length(units) > 0, F.sequence(F.lit(1), F.length(units), F.lit(4))).otherwise(F.array().cast("array<int>"))
    values = F.transform(at, lambda i: F.conv(F.substr(units, i, F.lit(4)), 16, 10).cast("bigint"))
    whole = F.aggregate(values, F.lit(0).cast("bigint"), lambda h, u: (h * 31 + u) % F.lit(1 << 32))
    return whole.bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint"))


def natural_key_sort(df: DataFrame, n: int, district: str = "district", cnt: str = "cnt") -> DataFrame:
    """The line jobs' secondary sort in their own placement: a district's rows in
    partition ``hash & MAX % n``, lower-cased district ascending and count
    descending inside it."""
    placed = df.repartitionById(n, (string_hash(F.col(district)) % n).cast("int"))
    return placed.sortWithinPartitions(F.lower(F.coalesce(F.col(district), F.lit(""))).asc(), F.col(cnt).desc())


def partition_sizes(df: DataFrame, *keys: str) -> DataFrame:
    """``part, n_rows, low, high``: rows of each partition that has some, and its
    least and greatest keys (colon-joined)."""
    key = F.struct(*keys)
    found = df.select(F.spark_partition_id().cast("bigint").alias("part"), key.alias("key")).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("low"), F.max("key").alias("high")
    )

    def text(c: str) -> Column:
        return F.concat_ws(":", *[F.coalesce(F.col(f"{c}.{k}").cast("string"), F.lit("")) for k in keys]).alias(c)

    return found.select("part", "n_rows", text("low"), text("high"))
