"""Job counters of a grouped count, from the frames of one run.

The line jobs report records in, records out of the map-side combine, groups and
records out. Here each is an observation on a frame of the same run: nothing is
scanned twice. To be seen, the combine is a grouping of its own, by input
partition and key; the groups are made from its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Observations by name, in the order in which they were asked for."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, its rows counted under ``name`` when a run has read them."""
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("n"))

    def values(self) -> dict[str, int]:
        """The counts, once a run has ended."""
        return {name: seen.get["n"] for name, seen in self._seen.items()}


def count_by_watched(df: DataFrame, keys: tuple[str, ...], counters: Counters, out: str = "cnt") -> DataFrame:
    """:func:`count_by` with its counters: ``records_in``, ``combined`` (a row for
    each key of each input partition) and ``groups``."""
    part = F.spark_partition_id().alias("_part")
    rows = counters.watch(df.select(*keys), "records_in").select(*keys, part)
    combined = rows.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("n"))
    groups = counters.watch(combined, "combined").groupBy(*keys).agg(F.sum("n").alias(out))
    return counters.watch(groups, "groups")
