"""Arrest rates per group.

Both forms are single aggregations with partial (map-side) aggregation:

* rounded: ``round(avg(flag * 100))`` to 0 decimals, still a double, with an
  exact-case ``'true'`` test;
* exact: ``arrests * 100 / rows`` unrounded, with an any-case test.

The two-aggregate form (all rows and arrested rows counted separately, then
joined) is kept as the slower equivalent of the rounded form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import arrest_flag, flag_as_int


def arrest_rate_rounded(
    df: DataFrame,
    keys=("year", "iucr", "description"),
    case_sensitive: bool = True,
    out: str = "pct",
) -> DataFrame:
    flag = flag_as_int(arrest_flag("arrest", case_sensitive))
    return df.groupBy(*keys).agg(F.round(F.avg(flag * 100)).alias(out))


def arrest_rate_exact(
    df: DataFrame,
    keys=("year", "iucr"),
    case_sensitive: bool = False,
    out: str = "pct",
) -> DataFrame:
    flag = flag_as_int(arrest_flag("arrest", case_sensitive))
    arrested = F.sum(flag).cast("double")
    return df.groupBy(*keys).agg((arrested * 100 / F.count(F.lit(1))).alias(out))


def arrest_rate_two_aggregates(
    df: DataFrame,
    keys=("year", "iucr", "description"),
    case_sensitive: bool = True,
    rounded: bool = True,
    out: str = "pct",
) -> DataFrame:
    """All-row counts left-joined to arrested-row counts on null-safe keys."""
    keys = list(keys)
    total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).alias("t")
    arrested = (
        df.filter(arrest_flag("arrest", case_sensitive))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_k"))
        .alias("a")
    )
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    joined = total.join(arrested, cond, "left")
    pct = (F.coalesce(F.col("a._k"), F.lit(0)) * 100).cast("double") / F.col("t._n")
    if rounded:
        pct = F.round(pct)
    return joined.select(*[F.col(f"t.{k}").alias(k) for k in keys], pct.alias(out))
