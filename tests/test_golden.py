"""Golden results on the 11-incident fixture (DataFrame path and line path)."""

from __future__ import annotations

from pyspark.sql import functions as F

from blotter import schema as S
from blotter.functions import strip_whitespace
from blotter.operators import (
    arrest_rate_exact,
    count_by_type,
    dirty_row_filter,
    join_lookup,
    order_by_district_count,
)
from blotter.plans import compose as C
from blotter.plans import textpath as TP
from blotter.session import scratch_path
from blotter.sinks import as_extract, write_delimited
from blotter.sources import read_codes, read_incidents, read_lines, split_key_value, split_positional


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_count_no_join(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    got = rows(C.type_count_by_district(inc))
    assert got == [
        (None, "$500 AND UNDER", 1),
        (" 03", "$500 AND UNDER", 1),
        ("001", "FIRST DEGREE MURDER", 2),
        ("001", "SIMPLE", 2),
        ("001", "SIMPLE BATTERY", 1),
        ("001", "THEFT BY LESSEE, NON-VEH", 1),
        ("002", "SIMPLE", 1),
        ("002", "A; B", 1),
        ("002", "UNKNOWN CODE", 1),
    ]


def test_count_left_join_lookup_as_is(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    codes = read_codes(spark, fixture_files["codes"])
    got = rows(C.type_count_with_lookup(inc, codes, how="left"))
    assert got == [
        (None, "$500 AND UNDER", 1),
        (" 03", "$500 AND UNDER", 1),
        ("001", "SIMPLE", 3),
        ("001", "FIRST DEGREE MURDER", 2),
        ("001", "$500 AND UNDER", 1),
        ("002", "SIMPLE", 1),
        ("002", None, 1),
        ("002", None, 1),
    ]


def test_count_left_join_padded_lookup(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    codes = read_codes(spark, fixture_files["codes"])
    got = rows(C.type_count_with_lookup(inc, codes, how="left", normalize="full"))
    assert ("002", "DOMESTIC", 1) in got
    assert got.count(("002", None, 1)) == 1


def test_broadcast_and_merge_equal_left(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    codes = read_codes(spark, fixture_files["codes"])
    base = rows(C.type_count_with_lookup(inc, codes, how="left"))
    for strategy in ("broadcast", "merge"):
        assert rows(C.type_count_with_lookup(inc, codes, how="left", strategy=strategy)) == base


def test_arrest_rate_rounded_exact_case(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    got = sorted(rows(C.arrest_pct(inc)), key=lambda r: (r[0], r[1]))
    assert got == sorted(
        [
            ("2001", "FIRST DEGREE MURDER", 50.0),
            ("2001", "SIMPLE", 0.0),
            ("2001", "A; B", 100.0),
            ("2001", "$500 AND UNDER", 0.0),
            ("2001", "THEFT BY LESSEE, NON-VEH", 0.0),
            ("2001", "UNKNOWN CODE", 0.0),
            ("2002", "SIMPLE", 50.0),
            ("2002", "SIMPLE BATTERY", 0.0),
            ("2002", "$500 AND UNDER", 0.0),
        ],
        key=lambda r: (r[0], r[1]),
    )
    # Year order holds in the collected result.
    years = [r[0] for r in rows(C.arrest_pct(inc))]
    assert years == sorted(years)


def test_two_aggregates_equal_conditional_average(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    assert sorted(rows(C.arrest_pct_two_aggregates(inc)), key=str) == sorted(
        rows(C.arrest_pct(inc)), key=str
    )


def _lines_positional(spark, path, positions):
    return split_positional(read_lines(spark, path), positions)


def test_line_path_count_with_dirty_filters(spark, fixture_files):
    pos = S.INCIDENT_POSITIONS
    parsed = _lines_positional(
        spark,
        fixture_files["incidents"],
        {"iucr": pos["iucr"], "district": pos["district"], "description": pos["description"]},
    )
    counted = count_by_type(dirty_row_filter(parsed, description="description"))
    got = rows(
        order_by_district_count(counted, case_insensitive=True, tiebreak=("iucr",)).select(
            "district", "description", "cnt"
        )
    )
    assert got == [
        ("", "$500 AND UNDER", 1),
        ("001", "FIRST DEGREE MURDER", 2),
        ("001", "SIMPLE", 2),
        ("001", "SIMPLE BATTERY", 1),
        ("002", "SIMPLE", 1),
        ("002", "UNKNOWN CODE", 1),
        ("x10", '"A', 1),
    ]


def test_line_path_inner_join_on_prepared_extract(spark, fixture_files):
    # Preparation: read with the quote-aware reader, drop the descriptive
    # columns, write without trimming (the ' 03' district must survive).
    full = read_incidents(spark, fixture_files["incidents"])
    slim_path = scratch_path(spark, "test-slim")
    write_delimited(
        as_extract(full.drop("primary_type", "description"), with_description=False),
        slim_path,
        header=True,
    )
    pos = S.INCIDENT_NO_DESCRIPTION_POSITIONS
    parsed = _lines_positional(spark, slim_path, {"iucr": pos["iucr"], "district": pos["district"]})
    counts = count_by_type(dirty_row_filter(parsed), with_description=False)
    counts = counts.withColumn("iucr", strip_whitespace("iucr"))
    lookup = TP.parse_code_records(split_key_value(read_lines(spark, fixture_files["codes"])))
    joined = join_lookup(counts, lookup, how="inner")
    got = rows(
        order_by_district_count(joined, case_insensitive=True, tiebreak=("iucr",)).select(
            "district", "description", "cnt"
        )
    )
    assert got == [
        ("", "$500 AND UNDER", 1),
        ("001", "SIMPLE", 3),
        ("001", "FIRST DEGREE MURDER", 2),
        ("001", "$500 AND UNDER", 1),
        ("002", "SIMPLE", 1),
    ]


def test_line_path_arrest_rate_any_case(spark, fixture_files):
    pos = S.INCIDENT_POSITIONS
    parsed = _lines_positional(
        spark,
        fixture_files["incidents"],
        {"year": pos["year"], "iucr": pos["iucr"], "arrest": pos["arrest"]},
    )
    parsed = parsed.filter(~F.col("year").contains("Year"))
    got = sorted(rows(arrest_rate_exact(parsed)))
    assert got == sorted(
        [
            ("2001", "0110", 50.0),
            ("2001", "0460", 0.0),
            ("2001", "0820", 0.0),
            ("2001", "9999", 0.0),
            ("2002", "0460", 66.66666666666667),
            ("2002", "0820", 0.0),
            ("x16", "0486", 0.0),
        ]
    )
    # The shifted year becomes null instead of failing the job.
    exact = C.arrest_pct_exact(parsed)
    assert (None, "0486", 0.0) in rows(exact)
