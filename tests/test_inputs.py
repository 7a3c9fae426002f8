"""Inputs of several kinds: mixed headers, damaged rows, routed scans, tagged joins, staged outputs."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F

from blotter import sinks
from blotter.operators import Counters, count_by, count_by_watched, tagged_union_join
from blotter.plans import jobs
from blotter.plans import textpath as TP
from blotter.session import STRICT_MALFORMED_CONF, kept_path, release_kept
from blotter.sinks import export_single_file, replace_output, write_delimited, write_lines
from blotter.sources import (
    MissingColumnError,
    MissingInputError,
    read_codes,
    read_delimited,
    read_extract,
    read_incidents,
    read_parsed,
    read_routed,
    split_damaged,
)
from tests.conftest import CODES_TEXT, incidents_text, local


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_files_of_one_folder_are_bound_by_their_own_headers(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "a.csv").write_text("IUCR;Arrest;District;Year\n0460;true;002;2001\n")
    (d / "b.csv").write_text("\nYear;District;Note;Arrest;IUCR\n2002;003;x;false;0820\n")
    with gzip.open(d / "c.csv.gz", "wt") as f:
        f.write("District;IUCR;Year;Arrest\n004;0110;2003;true\n")
    (d / "d.csv").write_text("IUCR;Arrest;District;Year\n0486;true;005;2004\n")
    (d / "_SUCCESS").write_text("")
    (d / ".hidden").write_text("x;y\n1;2\n")
    (d / "empty.csv").write_text("")
    want = [("0110", "true", "004", "2003"), ("0460", "true", "002", "2001"), ("0486", "true", "005", "2004"), ("0820", "false", "003", "2002")]
    assert rows(read_incidents(spark, str(d), with_description=False)) == want
    files = [str(d / n) for n in ("a.csv", "b.csv", "c.csv.gz", "d.csv")]
    assert rows(read_incidents(spark, files, with_description=False)) == want
    assert rows(read_incidents(spark, str(d / "*.csv"), with_description=False)) == [w for w in want if w[0] != "0110"]
    (d / "e.csv").write_text("IUCR;Arrest;Year\n0460;true;2001\n")
    with pytest.raises(MissingColumnError, match="e.csv.*District"):
        read_incidents(spark, str(d), with_description=False)


def test_lookup_and_extract_of_mixed_headers(spark, tmp_path):
    d = tmp_path / "codes"
    d.mkdir()
    (d / "a.csv").write_text("IUCR;Primary Description;Secondary Description\n0110;HOMICIDE;FIRST\n")
    (d / "b.csv").write_text("Secondary Description;IUCR;Primary Description\nSIMPLE;0460;BATTERY\n")
    assert rows(read_codes(spark, str(d))) == [("0110", "HOMICIDE", "FIRST"), ("0460", "BATTERY", "SIMPLE")]
    assert rows(read_extract(spark, str(d)).select("IUCR", "Secondary Description")) == [("0110", "FIRST"), ("0460", "SIMPLE")]
    (d / "c.csv").write_text("IUCR;Other\n1;2\n")
    with pytest.raises(MissingColumnError, match="c.csv"):
        read_extract(spark, str(d))


def test_damaged_rows_are_what_a_strict_read_drops(spark, tmp_path):
    p, q = tmp_path / "a.csv", tmp_path / "b.csv"
    p.write_text('a;b;c\n1;2;3\n4;5\n6;7;8;9\n"x;y";z;\n\n   \n;;\n')
    q.write_text("c;a;b\n3;1;2\nshort\n")
    whole, damaged = split_damaged(read_parsed(spark, [str(p), str(q)], ("a", "c")))
    assert rows(damaged) == [("4;5",), ("6;7;8;9",), ("short",)]
    assert damaged.count() == 3 and whole.count() == 4
    for key, value in STRICT_MALFORMED_CONF.items():
        spark.conf.set(key, value)
    try:
        strict = rows(read_delimited(spark, [str(p), str(q)], ("a", "c")))
    finally:
        for key in STRICT_MALFORMED_CONF:
            spark.conf.unset(key)
    assert rows(whole) == strict == sorted([("1", "3"), ("x;y", None), (None, None), ("1", "3")], key=str)


def test_count_job_writes_its_rejects(spark, tmp_path, capsys, monkeypatch):
    from tests.test_jobs import _NoStop

    text = incidents_text().splitlines()
    src, clean = tmp_path / "crimes.csv", tmp_path / "clean.csv"
    src.write_text("\n".join([text[0], "cut;off", *text[1:], ";".join(["x"] * 40)]) + "\n")
    clean.write_text("\n".join(text) + "\n")
    monkeypatch.setattr(jobs, "build_session", lambda **kw: _NoStop(spark))
    out, rejects, want = (str(tmp_path / n) for n in ("out", "rejects", "want"))
    assert jobs.main(["count", str(src), out, "--rejects", rejects, "--counters"]) == 0
    said = dict(line.split("\t") for line in capsys.readouterr().out.splitlines() if "\t" in line)
    assert said == {"rejects": "2", "records_in": "11", "combined": said["combined"], "groups": "9", "records_out": "9"}
    assert 9 <= int(said["combined"]) <= 11
    assert rows(spark.read.text(rejects)) == [("cut;off",), (";".join(["x"] * 40),)]
    jobs.count(spark, str(clean), want)
    assert rows(spark.read.text(out)) == rows(spark.read.text(want))


def test_routed_scan_of_two_files_in_one_folder(spark, tmp_path):
    d = tmp_path / "in put"
    d.mkdir()
    (d / "crimes.csv").write_text("a\nb\n")
    (d / "codes.csv").write_text("c\n")
    both = read_routed(spark, {"facts": str(d / "crimes.csv"), "codes": str(d / "codes.csv")})
    assert rows(both) == [("codes", "c"), ("facts", "a"), ("facts", "b")]
    # One input lies inside the other: the longer path wins, nothing is read twice.
    nested = read_routed(spark, {"facts": str(d), "codes": str(d / "codes.csv")})
    assert rows(nested) == rows(both)
    assert nested._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(MissingInputError):
        read_routed(spark, {"facts": str(d / "nope")})


def test_one_scan_join_of_one_folder_equals_the_join(spark, fixture_files, tmp_path):
    d = tmp_path / "all"
    d.mkdir()
    (d / "crimes.csv").write_text(incidents_text(with_description=False))
    (d / "codes.csv").write_text(CODES_TEXT)
    want = TP.tagged_cogroup_join(spark, TP.line_code_counts(spark, str(d / "crimes.csv")), str(d / "codes.csv"))
    got = TP.one_scan_join(spark, str(d), str(d / "codes.csv"))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()] and got.count() == 5
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    jobs.count_join(spark, str(d / "crimes.csv"), str(d / "codes.csv"), a, lines=True)
    jobs.count_join(spark, str(d), str(d / "codes.csv"), b, lines=True, one_scan=True)
    assert rows(spark.read.text(a)) == rows(spark.read.text(b)) and spark.read.text(a).count() == 5


def test_tagged_union_equals_the_inner_join(spark):
    counts = spark.createDataFrame(
        [("1", "a", 5), ("1", "b", 6), ("2", "a", 7), (None, "a", 8), ("9", "a", 9)], "iucr string, district string, cnt long"
    )
    lookup = spark.createDataFrame(
        [("1", "x"), ("1", "y"), ("1", "y"), ("2", None), (None, "n"), ("3", "z")], "iucr string, description string"
    )
    want = counts.join(lookup, "iucr").select(*counts.columns, "description")
    assert rows(tagged_union_join(counts, lookup)) == rows(want) and want.count() == 7
    assert rows(tagged_union_join(counts, lookup.where("false"))) == []
    assert rows(tagged_union_join(counts.where("false"), lookup)) == []


def test_a_failed_run_leaves_the_old_output(spark, tmp_path):
    out = str(tmp_path / "out")
    write_delimited(spark.createDataFrame([("old",)], "x string"), out)
    bad = spark.range(1000).repartition(4).select(F.when(F.col("id") == 777, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("string"))
    for write in (write_delimited, write_lines):
        with pytest.raises(Exception, match="midway"):
            write(bad, out)
        assert rows(spark.read.text(out)) == [("old",)]
    assert os.listdir(tmp_path) == ["out"]
    write_lines(spark.createDataFrame([("new",)], "x string"), out)
    assert rows(spark.read.text(out)) == [("new",)] and os.listdir(tmp_path) == ["out"]


def test_a_swap_that_fails_brings_the_old_output_back(spark, tmp_path):
    out = str(tmp_path / "out")
    write_lines(spark.createDataFrame([("old",)], "x string"), out)
    with pytest.raises(Exception):
        replace_output(spark, out, lambda staging: None)  # nothing was written
    assert rows(spark.read.text(out)) == [("old",)] and os.listdir(tmp_path) == ["out"]


@pytest.mark.parametrize("header", [False, True])
def test_single_file_from_parallel_parts_equals_one_task(spark, tmp_path, header):
    rows_ = [(f"k{i:04d}", ' "q;' if i % 7 == 0 else None if i % 5 == 0 else "", i) for i in range(2000)]
    df = spark.createDataFrame(rows_, "k string, t string, n long").repartition(6).orderBy("k")
    joined, plain = str(tmp_path / "joined"), str(tmp_path / "plain")
    export_single_file(df, joined, header=header)
    write_delimited(df.coalesce(1), plain, header=header)

    def only(path):
        names = [n for n in os.listdir(path) if n.startswith("part-")]
        assert len(names) == 1 and not any(n.startswith("_") and n != "_SUCCESS" for n in os.listdir(path))
        return open(os.path.join(path, names[0]), "rb").read()

    assert only(joined) == only(plain) and len(only(plain)) > 10_000
    export_single_file(df.where("false"), joined, header=header)
    assert only(joined) == (b"k;t;n\n" if header else b"")


def test_single_file_export_has_no_task_over_all_rows(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(sinks, "write_delimited", lambda df, *a, **k: (seen.append(df), write_delimited(df, *a, **k)))
    export_single_file(spark.range(1000).repartition(5), str(tmp_path / "out"))
    assert [d.rdd.getNumPartitions() for d in seen] == [5]
    # A file system that joins nothing: one task, one file.
    monkeypatch.setattr(sinks, "can_join_files", lambda spark, path: False)
    export_single_file(spark.range(1000).repartition(5), str(tmp_path / "out"))
    assert [d.rdd.getNumPartitions() for d in seen] == [5, 1]
    assert len([n for n in os.listdir(tmp_path / "out") if n.startswith("part-")]) == 1


def test_counters_of_a_grouped_count(spark):
    df = spark.createDataFrame([(str(i % 5), str(i % 2)) for i in range(300)], "a string, b string").repartition(3)
    seen = Counters()
    got = rows(count_by_watched(df, ("a", "b"), seen))
    assert got == rows(count_by(df, "a", "b"))
    assert seen.values() == {"records_in": 300, "combined": 30, "groups": 10}


def test_kept_files_go_with_the_session_release(spark):
    path = kept_path(spark, "kept")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(local(path))
    release_kept(spark)
    assert not os.path.exists(local(path))


@pytest.mark.parametrize("argv", [
    ["count", "a", "b", "--partitions", "3"], ["count", "a", "b", "--lines", "--rejects", "c"],
    ["count", "a", "b", "--lines", "--counters"], ["count", "a", "b", "--rejects", "c", "--strict"],
    ["count-join", "a", "c", "b", "--one-scan"], ["arrest-rate", "a", "b", "--split-points", "p"], ["arrest-rate", "a", "b", "--lines", "--split-points", "p"],
    ["arrest-rate", "a", "b", "--exact", "--split-points", "p", "--single-file"],
])
def test_new_options_without_effect_are_rejected(argv, capsys):
    with pytest.raises(SystemExit):
        jobs.main(argv)
    assert "--" in capsys.readouterr().err


def test_carried_forward_equals_joins_of_random_tables(spark):
    import random

    rnd = random.Random(11)
    for _ in range(3):
        keys = [None, *map(str, range(rnd.randint(1, 9)))]
        counts = [(rnd.choice(keys), rnd.choice("ab"), i) for i in range(rnd.randint(0, 60))]
        lookup = [(rnd.choice(keys), rnd.choice(["x", "y", None])) for _ in range(rnd.randint(0, 25))]
        left = spark.createDataFrame(counts, "iucr string, district string, cnt long").repartition(3)
        right = spark.createDataFrame(lookup, "iucr string, description string").repartition(2)
        want = sorted(
            ((k, d, n, text) for k, d, n in counts for c, text in lookup if k is not None and k == c), key=str
        )
        assert rows(tagged_union_join(left, right)) == want
