"""Ordering and output layout.

* Global orders use ``orderBy``: a sampled range exchange, then a sort per
  partition; the total order is spread over many tasks, never one.
* The secondary sort of the line jobs (hash by district, sort within the
  partition by district and descending count) is ``repartition`` +
  ``sortWithinPartitions``.
* The total-order partitioner of the rate job is ``repartitionByRange``; a
  tie-breaker column in the range key lets a hot year be split across
  partitions instead of landing in one.

These are meant for aggregated results. Sorting is always the last step,
after any join (a sort below a join is not preserved by the join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def district_sort_key(district: str = "district", case_insensitive: bool = False) -> Column:
    """Ascending district key; null first. The case-insensitive form lower-cases
    the key and treats null like the empty string."""
    d = F.col(district)
    if case_insensitive:
        return F.lower(F.coalesce(d, F.lit(""))).asc()
    return d.asc_nulls_first()


def order_by_district_count(
    df: DataFrame,
    district: str = "district",
    cnt: str = "cnt",
    case_insensitive: bool = False,
    tiebreak: tuple[str, ...] = (),
) -> DataFrame:
    """District ascending, count descending, then ``tiebreak`` ascending."""
    return df.orderBy(
        district_sort_key(district, case_insensitive),
        F.col(cnt).desc(),
        *[F.col(c).asc_nulls_first() for c in tiebreak],
    )


def order_by_year(df: DataFrame, year: str = "year", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Year ascending (ties in ``tiebreak`` order)."""
    return df.orderBy(F.col(year).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tiebreak])


def hash_partition(df: DataFrame, n: int, key: str = "district") -> DataFrame:
    """Every row of one key in the same one of ``n`` partitions."""
    return df.repartition(n, F.col(key))


def secondary_sort(
    df: DataFrame, n: int, district: str = "district", cnt: str = "cnt"
) -> DataFrame:
    """Hash by district into ``n`` partitions; inside each, lower-cased
    district ascending and count descending."""
    return hash_partition(df, n, district).sortWithinPartitions(
        district_sort_key(district, case_insensitive=True), F.col(cnt).desc()
    )


def range_sort(df: DataFrame, n: int, keys: tuple[str, ...]) -> DataFrame:
    """Total order over ``n`` range partitions: partition ``i`` holds keys
    below those of partition ``i + 1``, each partition sorted."""
    cols = [F.col(k).asc_nulls_first() for k in keys]
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


def split_points(
    df: DataFrame, key: str, n_partitions: int, row_key: str, fraction: float = 0.01
) -> DataFrame:
    """Range split points for ``n_partitions`` from a sample of ``key``.

    A row is in the sample if the hash of ``row_key``, which names it, falls
    into the first ``fraction`` of all hashes, so the sample is the same in
    every run and layout (the sampling operator itself). The quantiles come
    from ``percentile_approx``, whose sketch has bounded memory and is exact
    below its accuracy. Returns one row: the ``n_partitions - 1`` ascending
    points, comma-joined (partition ``i`` takes keys up to point ``i``), and
    the sample size. A key with fewer distinct values than partitions yields
    repeated points, i.e. empty partitions; ``range_sort`` therefore ranges
    over the key plus a tie-breaker column.
    """
    probs = [i / n_partitions for i in range(1, n_partitions)]
    place = F.conv(F.substring(F.md5(F.col(row_key)), 1, 8), 16, 10).cast("bigint")
    sample = df.where(place < F.lit(int(fraction * 16**8))).select(F.col(key).try_cast("bigint").alias(key))
    return sample.agg(
        F.concat_ws(",", F.percentile_approx(key, probs).cast("array<string>")).alias("split_points"),
        F.count(F.lit(1)).alias("sampled_rows"),
    )
