"""The workload's questions, composed from operators over canonical frames.

Each function takes the canonical incident frame (``iucr, primary_type,
description, arrest, district, year``) and, where needed, a code lookup
(``iucr, primary_description, secondary_description``), and returns a lazy,
ordered result. Variants that differ observably are separate, named options:

* direct count vs count on the code joined to the lookup (the description is
  not a function of the code, so these are different questions);
* left vs inner join, lookup as shipped vs normalised codes;
* no cleaning (plain string order) vs the line jobs' dirty-row filters
  (case-insensitive order);
* rounded exact-case rate per ``(year, code, description)`` vs unrounded
  any-case rate per ``(year, code)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions import normalize_code, strip_whitespace, to_bigint
from blotter.operators import (
    Counters,
    arrest_rate_exact,
    arrest_rate_rounded,
    arrest_rate_two_aggregates,
    count_by_type,
    count_by_watched,
    dirty_row_filter,
    join_lookup,
    lookup_descriptions,
    order_by_district_count,
    order_by_year,
)
from blotter.session import kept_path

COUNT_COLUMNS = ("district", "description", "cnt")

_NORMALIZERS = {
    None: None,
    "whitespace": strip_whitespace,
    "full": normalize_code,
}


def type_count_by_district(incidents: DataFrame, clean: bool = False, counters: Counters | None = None) -> DataFrame:
    """Incidents per ``(code, district, description)``; district ascending,
    count descending; the code is dropped from the output (so equal
    ``(district, description)`` pairs of different codes stay separate).
    ``counters`` watch the run's records in, combined, groups and out."""
    df = incidents.select("iucr", "district", "description")
    if clean:
        df = dirty_row_filter(df, description="description")
    if counters is None:
        counted = count_by_type(df, with_description=True)
    else:
        # Stored before the sort, whose sampling would read (and count) the groups twice.
        path = kept_path(df.sparkSession, "counted")
        counted = count_by_watched(df, ("iucr", "district", "description"), counters)
        counted.write.parquet(path)
        counted = df.sparkSession.read.schema(counted.schema).parquet(path)
    result = order_by_district_count(
        counted, case_insensitive=clean, tiebreak=("iucr", "description")
    ).select(*COUNT_COLUMNS)
    return result if counters is None else counters.watch(result, "records_out")


def code_counts(incidents: DataFrame, clean: bool = False) -> DataFrame:
    """Pre-aggregation below the lookup join: counts per ``(code, district)``."""
    df = incidents.select("iucr", "district")
    if clean:
        df = dirty_row_filter(df)
    return count_by_type(df, with_description=False)


def type_count_with_lookup(
    incidents: DataFrame,
    codes: DataFrame,
    how: str = "left",
    strategy: str = "auto",
    clean: bool = False,
    normalize: str | None = None,
) -> DataFrame:
    """Count on the short code, then join the description from the lookup.

    ``normalize``: ``None`` joins codes as they are, ``'whitespace'`` strips
    whitespace on both sides, ``'full'`` also pads short codes with zeros.
    Normalisation is applied after the count (to aggregated rows only); codes
    that become equal by padding are one code, so their counts are added up and
    the lookup keeps one description (the least) for each. The sort runs after
    the join.
    """
    counts = code_counts(incidents, clean=clean)
    lookup = lookup_descriptions(codes)
    fix = _NORMALIZERS[normalize]
    if fix is not None:
        counts = counts.withColumn("iucr", fix("iucr"))
        lookup = lookup.withColumn("iucr", fix("iucr"))
    if normalize == "full":
        counts = counts.groupBy("iucr", "district").agg(F.sum("cnt").alias("cnt"))
        lookup = lookup.groupBy("iucr").agg(F.min("description").alias("description"))
    joined = join_lookup(counts, lookup, how=how, strategy=strategy)
    return order_by_district_count(joined, case_insensitive=clean, tiebreak=("iucr",)).select(
        *COUNT_COLUMNS
    )


def arrest_pct(incidents: DataFrame) -> DataFrame:
    """Rounded percentage of exact-``'true'`` arrests per
    ``(year, code, description)``; output ``year, description, pct`` by year."""
    rates = arrest_rate_rounded(incidents.select("year", "iucr", "description", "arrest"))
    return order_by_year(rates, tiebreak=("iucr", "description")).select("year", "description", "pct")


def arrest_pct_two_aggregates(incidents: DataFrame) -> DataFrame:
    """Same result as :func:`arrest_pct` from two aggregates joined."""
    rates = arrest_rate_two_aggregates(incidents.select("year", "iucr", "description", "arrest"))
    return order_by_year(rates, tiebreak=("iucr", "description")).select("year", "description", "pct")


def arrest_rates_exact(incidents: DataFrame) -> DataFrame:
    """Unrounded percentage of any-case ``'true'`` arrests per ``(year, code)``,
    in no order; the year is parsed to a number (null when malformed)."""
    rates = arrest_rate_exact(incidents.select("year", "iucr", "arrest"))
    return rates.select(to_bigint("year").alias("year"), "iucr", "pct")


def arrest_pct_exact(incidents: DataFrame) -> DataFrame:
    """:func:`arrest_rates_exact` by year."""
    return order_by_year(arrest_rates_exact(incidents), tiebreak=("iucr",))


def normalized_codes(codes: DataFrame) -> DataFrame:
    """Lookup with whitespace-free, zero-padded codes: ``iucr, description``."""
    return lookup_descriptions(codes).withColumn("iucr", normalize_code("iucr"))
