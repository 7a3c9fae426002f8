"""Counting incidents per key.

``groupBy(...).agg(count)`` plans as a partial ``HashAggregate`` in every map
task followed by a final one after the shuffle, so a hot key (say a district
with a third of all rows) reaches the reducer as one partial row per map
task: the map-side combine of the line jobs comes for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, out: str = "cnt") -> DataFrame:
    """Row count per distinct key combination (nulls form their own group)."""
    return df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_by_type(df: DataFrame, with_description: bool = True) -> DataFrame:
    """Counts per ``(iucr, district[, description])``.

    With the description (the direct form) the key is three columns; without
    it (the pre-aggregation before a lookup join) only the short code and
    the district are grouped. The description is not a function of the code
    in real data, so the two forms are different queries.
    """
    keys = ("iucr", "district", "description") if with_description else ("iucr", "district")
    return count_by(df, *keys)
