"""Joins of aggregated counts with the code lookup.

The counts are always aggregated *below* the join (Catalyst does not push an
aggregate under a join by itself), so the join sees one row per
``(code, district)`` instead of one per incident.

Strategies:

* ``auto``      -- Catalyst and AQE choose by measured bytes: a lookup under
  ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is joined
  by shuffle.
* ``broadcast`` -- the lookup is broadcast if its measured rows and bytes stay
  within ``BROADCAST_BYTES``, also above that threshold; a larger lookup, or a
  session that has turned broadcasts off, gets the plan of ``auto``.
* ``merge``     -- reduce-side join: both inputs hash-partitioned on the code,
  sorted, merged per key (what a tagged union plus co-group does by hand,
  without buffering per-key lists).

:func:`tagged_union_join` is the line job's own form: both inputs in one table with
a tag, one exchange by the code, and the lookup's entries carried forward to the
counts behind them. It has no join operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: A lookup of at most so many bytes may be broadcast because the caller asks.
BROADCAST_BYTES = 64 << 20


def small_enough(df: DataFrame, most: int) -> bool:
    """Whether the rows of ``df``, counted and measured, take at most ``most``
    bytes (texts, and 16 bytes for each value)."""
    width = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    total = df.agg(F.coalesce(F.sum(sum(width, F.lit(0)).cast("bigint")), F.lit(0))).first()[0]
    return total <= most


def lookup_descriptions(
    codes: DataFrame, description: str = "secondary_description", key: str = "iucr"
) -> DataFrame:
    """Project the lookup to ``(iucr, description)`` before any join."""
    return codes.select(F.col(key).alias("iucr"), F.col(description).alias("description"))


def join_lookup(
    counts: DataFrame,
    lookup: DataFrame,
    how: str = "left",
    strategy: str = "auto",
    key: str = "iucr",
) -> DataFrame:
    """Equi-join ``counts`` with ``lookup`` on ``key``; ``how`` is ``left`` or
    ``inner``. The lookup is the build side in every strategy."""
    if strategy == "merge":
        lookup = lookup.hint("merge")
    elif strategy == "broadcast":
        allowed = counts.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
        if allowed and small_enough(lookup, BROADCAST_BYTES):
            lookup = F.broadcast(lookup)
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy: {strategy}")
    return counts.join(lookup, key, how)


FACT, ENTRY = 1, 0


def carried_forward(tagged: DataFrame, key: str, value: str, times: str | None = None) -> DataFrame:
    """The facts of a tagged table with the entries of their key: an inner join.

    ``tagged`` has ``tag`` (``ENTRY`` or ``FACT``), ``key``, ``value`` (of entries)
    and any columns of facts. One exchange by ``key``; inside a key the entries
    come first, and a running window hands them to the facts that follow. Only
    the entries of one key are held together, never its facts. A key with
    several entries gives each fact once for each of them (``times`` names a
    count of equal entries); null keys match nothing, as in a join."""
    entry = F.struct(F.col(value).alias("value"), (F.col(times) if times else F.lit(1)).cast("int").alias("times"))
    so_far = Window.partitionBy(key).orderBy("tag").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    facts = [c for c in tagged.columns if c not in ("tag", value)]
    rows = tagged.where(F.col(key).isNotNull()).withColumn("entries", F.collect_list(F.when(F.col("tag") == ENTRY, entry)).over(so_far))
    each = F.flatten(F.transform("entries", lambda e: F.array_repeat(e["value"], e["times"])))
    return rows.where(F.col("tag") == FACT).select(*facts, F.explode(each).alias(value))


def tagged_union_join(counts: DataFrame, lookup: DataFrame, key: str = "iucr", value: str = "description") -> DataFrame:
    """``counts`` inner-joined to ``lookup`` (``key, value``) by one exchange of
    both, see :func:`carried_forward`."""
    entries = lookup.select(F.lit(ENTRY).alias("tag"), key, value)
    facts = counts.select(F.lit(FACT).alias("tag"), "*")
    return carried_forward(entries.unionByName(facts, allowMissingColumns=True), key, value).select(*counts.columns, value)
