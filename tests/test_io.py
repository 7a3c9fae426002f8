"""Sources, sinks and scalar functions."""

from __future__ import annotations

import os

import pytest

from blotter.functions import normalize_code, pad_code, strip_whitespace
from blotter.session import STRICT_MALFORMED_CONF, scratch_path
from blotter.sinks import record_line, write_delimited, write_lines
from blotter.sources import (
    MissingColumnError,
    MissingInputError,
    read_codes,
    read_delimited,
    read_incidents,
    read_lines,
    split_key_value,
    split_positional,
)
from tests.conftest import local

FIVE = tuple("abcde")
MALFORMED = "a;b;c;d;e\n1;2;3;4;5\n1;2\n1;2;3;4;5;6\n;;;;\n"


def test_malformed_rows_depend_on_column_pruning(spark, tmp_path):
    p = tmp_path / "malformed.csv"
    p.write_text(MALFORMED)
    key = "spark.sql.csv.parser.columnPruning.enabled"
    lenient = read_delimited(spark, str(p), FIVE).select("a").count()
    spark.conf.set(key, STRICT_MALFORMED_CONF[key])
    try:
        strict = read_delimited(spark, str(p), FIVE).select("a").count()
    finally:
        spark.conf.unset(key)
    assert lenient == 4
    assert strict == 2


def test_missing_input_is_a_clear_error(spark, tmp_path):
    with pytest.raises(MissingInputError, match="Invalid input path"):
        read_incidents(spark, str(tmp_path / "nope.csv"))


def test_quote_aware_reader_keeps_whitespace(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    assert inc.columns == ["iucr", "primary_type", "description", "arrest", "district", "year"]
    districts = {r.district for r in inc.select("district").collect()}
    assert " 03" in districts and None in districts
    descs = {r.description for r in inc.select("description").collect()}
    assert "A; B" in descs and "THEFT BY LESSEE, NON-VEH" in descs


def test_directory_scan_reads_all_part_files(spark, fixture_files):
    inc = read_incidents(spark, fixture_files["incidents"])
    out = scratch_path(spark, "dir-scan")
    write_delimited(inc.repartition(3), out, header=True)
    assert len([f for f in os.listdir(local(out)) if f.startswith("part-")]) >= 2
    assert read_delimited(spark, out, tuple(inc.columns)).count() == 11


def test_csv_sink_without_header_keeps_whitespace_and_nulls(spark):
    df = spark.createDataFrame([(" 03", "a", 1), (None, "", 2)], "district string, d string, cnt long")
    out = scratch_path(spark, "sink")
    write_delimited(df.coalesce(1), out)
    text = "".join(open(os.path.join(local(out), f)).read() for f in os.listdir(local(out)) if f.startswith("part-"))
    assert text.splitlines() == [" 03;a;1", ';"";2']


def test_overwrite_replaces_output(spark):
    out = scratch_path(spark, "overwrite")
    write_delimited(spark.createDataFrame([("a",)], "x string"), out)
    write_delimited(spark.createDataFrame([("b",), ("c",)], "x string"), out)
    assert sorted(r.value for r in read_lines(spark, out).collect()) == ["b", "c"]


def test_text_sink_record_format(spark):
    df = spark.createDataFrame([("001", "SIMPLE", 3), (None, None, 1)], "district string, description string, cnt long")
    out = scratch_path(spark, "text")
    write_lines(df.select(record_line().alias("line")), out)
    lines = sorted(r.value for r in read_lines(spark, out).collect())
    assert lines == ["001;\tSIMPLE;3", ";\t;1"]


def test_positional_split_short_line_gives_null(spark):
    df = spark.createDataFrame([("a;b",), ("a;b;c;d",), ("a;b;;",)], "value string")
    fields = {"first": 0, "third": 2, "fourth": 3}
    got = [tuple(r) for r in split_positional(df, fields, keep_short=True).collect()]
    assert got == [("a", None, None), ("a", "c", "d"), ("a", "", "")]
    assert [tuple(r) for r in split_positional(df, fields).collect()] == got[1:]


def test_separators_are_literal(spark):
    df = spark.createDataFrame([("a|b|c",)], "value string")
    assert tuple(split_positional(df, {"x": 0, "y": 1}, sep="|").first()) == ("a", "b")
    assert tuple(split_key_value(df, sep="|").first()) == ("a", "b|c")


def test_columns_are_bound_by_header_name(spark, tmp_path):
    rows = [("District", "ID", "Arrest", "Year", "Extra", "IUCR", "Description", "Primary Type"),
            ("001", "1", "true", "2001", "x", "0110", "SIMPLE", "P"), ("002", "2", "false", "2002", "y", "486", "B;C", "P")]
    path = tmp_path / "moved.csv"
    path.write_text("".join(";".join(f'"{v}"' if ";" in v else v for v in r) + "\n" for r in rows))
    got = sorted(tuple(r) for r in read_incidents(spark, str(path)).collect())
    assert got == [("0110", "P", "SIMPLE", "true", "001", "2001"), ("486", "P", "B;C", "false", "002", "2002")]
    slim = read_incidents(spark, str(path), with_description=False)
    assert slim.columns == ["iucr", "arrest", "district", "year"] and slim.count() == 2
    (tmp_path / "short.csv").write_text("ID;IUCR;Arrest;Year\n1;0110;true;2001\n")
    with pytest.raises(MissingColumnError, match="District"):
        read_incidents(spark, str(tmp_path / "short.csv"), with_description=False)
    with pytest.raises(MissingInputError):
        read_lines(spark, str(tmp_path / "nope.txt"))


def test_key_value_split_at_first_separator(spark):
    df = spark.createDataFrame([("001;0110__\t5",), ("nosep",)], "value string")
    got = [tuple(r) for r in split_key_value(df).collect()]
    assert got == [("001", "0110__\t5"), ("nosep", "")]


def test_code_functions(spark):
    df = spark.createDataFrame([("486",), (" 0110\t",), ("110A5",), ("0820",), (None,)], "c string")
    got = [tuple(r) for r in df.select(
        strip_whitespace("c").alias("s"), pad_code("c").alias("p"), normalize_code("c").alias("n")
    ).collect()]
    assert got == [
        ("486", "0486", "0486"),
        ("0110", " 0110\t", "0110"),
        ("110A5", "110A5", "110A5"),  # longer codes are never truncated
        ("0820", "0820", "0820"),
        (None, None, None),
    ]


def test_lookup_reader(spark, fixture_files):
    codes = read_codes(spark, fixture_files["codes"])
    assert codes.columns == ["iucr", "primary_description", "secondary_description"]
    assert codes.count() == 4
