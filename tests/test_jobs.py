"""File-to-file jobs on the fixture files."""

from __future__ import annotations

import os

import pytest

from blotter.plans import jobs
from blotter.session import scratch_path
from blotter.sources import read_lines
from tests.conftest import local


def _lines(spark, path):
    return [r.value for r in read_lines(spark, path).collect()]


def _text(path):
    d = local(path)
    return "".join(open(os.path.join(d, f)).read() for f in sorted(os.listdir(d)) if f.startswith("part-"))


def test_count_job_writes_ordered_csv(spark, fixture_files):
    out = scratch_path(spark, "job-count")
    jobs.count(spark, fixture_files["incidents"], out)
    lines = _text(out).splitlines()
    assert lines[0] == ";$500 AND UNDER;1"
    assert lines[1] == " 03;$500 AND UNDER;1"
    assert lines[2] == "001;FIRST DEGREE MURDER;2"
    assert '002;"A; B";1' in lines


def test_count_job_single_file_for_charts(spark, fixture_files):
    out = scratch_path(spark, "job-count-single")
    jobs.count(spark, fixture_files["incidents"], out, single_file=True)
    assert len([f for f in os.listdir(local(out)) if f.startswith("part-")]) == 1
    assert _text(out).splitlines()[2] == "001;FIRST DEGREE MURDER;2"


def test_count_job_line_form(spark, fixture_files):
    out = scratch_path(spark, "job-count-lines")
    jobs.count(spark, fixture_files["incidents"], out, lines=True)
    assert _text(out).splitlines() == [
        ";\t$500 AND UNDER;1",
        "001;\tFIRST DEGREE MURDER;2",
        "001;\tSIMPLE;2",
        "001;\tSIMPLE BATTERY;1",
        "002;\tSIMPLE;1",
        "002;\tUNKNOWN CODE;1",
        'x10;\t"A;1',
    ]


def test_prepare_then_join_jobs(spark, fixture_files):
    slim = scratch_path(spark, "job-slim")
    jobs.drop_columns(spark, fixture_files["incidents"], slim, single_file=True)
    assert len([f for f in os.listdir(local(slim)) if f.startswith("part-")]) == 1
    codes = scratch_path(spark, "job-codes")
    jobs.normalize_codes(spark, fixture_files["codes"], codes)
    assert "0486;BATTERY;DOMESTIC" in _text(codes).splitlines()
    out = scratch_path(spark, "job-join")
    jobs.count_join(spark, slim, codes, out, how="left", strategy="broadcast")
    lines = _text(out).splitlines()
    assert "002;DOMESTIC;1" in lines and "002;;1" in lines
    assert lines[2] == "001;SIMPLE;3"


def test_count_join_line_form(spark, fixture_files):
    slim = scratch_path(spark, "job-slim-lines")
    jobs.drop_columns(spark, fixture_files["incidents"], slim)
    out = scratch_path(spark, "job-join-lines")
    jobs.count_join(spark, slim, fixture_files["codes"], out, lines=True)
    assert _text(out).splitlines() == [
        ";\t$500 AND UNDER;1",
        "001;\tSIMPLE;3",
        "001;\tFIRST DEGREE MURDER;2",
        "001;\t$500 AND UNDER;1",
        "002;\tSIMPLE;1",
    ]


def test_arrest_rate_jobs(spark, fixture_files):
    out = scratch_path(spark, "job-rate")
    jobs.arrest_rate(spark, fixture_files["incidents"], out)
    lines = _text(out).splitlines()
    assert "2001;FIRST DEGREE MURDER;50.0" in lines and len(lines) == 9
    exact = scratch_path(spark, "job-rate-exact")
    jobs.arrest_rate(spark, fixture_files["incidents"], exact, exact=True, partitions=3, text=True)
    assert "2002\t0460 \t66.66666666666667" in _lines(spark, exact)
    raw = scratch_path(spark, "job-rate-lines")
    jobs.arrest_rate(spark, fixture_files["incidents"], raw, partitions=3, text=True, lines=True)
    got = _lines(spark, raw)
    assert "\t0486 \t0.0" in got and "2002\t0460 \t66.66666666666667" in got and len(got) == 7


def test_parquet_copy_gives_same_counts(spark, fixture_files):
    pq = scratch_path(spark, "job-parquet") + ".parquet"
    jobs.to_parquet(spark, fixture_files["incidents"], pq)
    a, b = scratch_path(spark, "job-a"), scratch_path(spark, "job-b")
    jobs.count(spark, fixture_files["incidents"], a)
    jobs.count(spark, pq, b)
    assert _text(a) == _text(b)


def test_parquet_copy_of_the_slim_extract_feeds_the_join(spark, fixture_files):
    slim = scratch_path(spark, "job-slim-pq-src")
    jobs.drop_columns(spark, fixture_files["incidents"], slim)
    pq = scratch_path(spark, "job-slim") + ".parquet"
    jobs.to_parquet(spark, slim, pq, with_description=False)
    a, b = scratch_path(spark, "job-join-csv"), scratch_path(spark, "job-join-pq")
    jobs.count_join(spark, slim, fixture_files["codes"], a)
    jobs.count_join(spark, pq, fixture_files["codes"], b)
    assert _text(a) == _text(b)
    assert "001;SIMPLE;3" in _text(b).splitlines()


def test_missing_input_exit_code(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda **kw: _NoStop(spark))
    assert jobs.main(["count", str(tmp_path / "missing.csv"), str(tmp_path / "out")]) == 2


class _NoStop:
    def __init__(self, spark):
        self._s = spark

    def __getattr__(self, name):
        return getattr(self._s, name)

    def stop(self):
        pass


def test_command_line_in_a_fresh_process(spark, fixture_files):
    import subprocess
    import sys

    out = scratch_path(spark, "job-cli")
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    proc = subprocess.run(
        [sys.executable, "-m", "blotter.plans.jobs", "count", fixture_files["incidents"], local(out), "--lines"],
        env=env,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert _text(out).splitlines()[-1] == 'x10;\t"A;1'


def test_full_slim_and_shuffled_extract_give_the_same_rows(spark, fixture_files, tmp_path):
    import random

    lines = [ln.split(";") for ln in open(fixture_files["incidents"]).read().splitlines() if '"' not in ln]
    order = random.Random(1).sample(range(len(lines[0])), len(lines[0]))
    full, moved = tmp_path / "full.csv", tmp_path / "moved.csv"
    full.write_text("".join(";".join(f) + "\n" for f in lines))
    moved.write_text("".join(";".join(f[i] for i in order) + "\n" for f in lines))
    slim = str(tmp_path / "slim")
    jobs.drop_columns(spark, str(full), slim)
    for run in (
        lambda src, out: jobs.count_join(spark, src, fixture_files["codes"], out),
        lambda src, out: jobs.count(spark, src, out) if src != slim else None,
        lambda src, out: jobs.arrest_rate(spark, src, out, exact=True),
    ):
        seen = set()
        for i, src in enumerate((str(full), str(moved), slim)):
            out = str(tmp_path / f"out-{id(run)}-{i}")
            run(src, out)
            if os.path.isdir(out):
                seen.add(tuple(sorted(r.value for r in spark.read.text(out).collect())))
        assert len(seen) == 1 and all(seen)


def test_a_parquet_copy_is_known_by_its_files(spark, fixture_files, tmp_path):
    copy, a, b = str(tmp_path / "x"), str(tmp_path / "a"), str(tmp_path / "b")
    jobs.to_parquet(spark, fixture_files["incidents"], copy)
    jobs.count(spark, copy, a)
    jobs.count(spark, fixture_files["incidents"], b)
    assert sorted(spark.read.text(a).collect()) == sorted(spark.read.text(b).collect())


@pytest.mark.parametrize("argv", [
    ["count", "a", "b", "--lines", "--clean"], ["count", "a", "b", "--lines", "--single-file"],
    ["count-join", "a", "c", "b", "--lines", "--how", "inner"], ["count-join", "a", "c", "b", "--lines", "--normalize", "full"],
    ["arrest-rate", "a", "b", "--text"], ["arrest-rate", "a", "b", "--partitions", "3"],
    ["arrest-rate", "a", "b", "--exact", "--text", "--single-file"],
])
def test_options_without_effect_are_rejected(argv, capsys):
    with pytest.raises(SystemExit):
        jobs.main(argv)
    assert "--" in capsys.readouterr().err


def test_padded_codes_are_one_code(spark):
    from blotter.plans import compose as C

    facts = spark.createDataFrame([("110", "001"), ("0110", "001"), ("0110 ", "001")], "iucr string, district string")
    codes = spark.createDataFrame([("0110", "P", "X"), ("110", "P", "Y")], "iucr string, primary_description string, secondary_description string")
    assert [tuple(r) for r in C.type_count_with_lookup(facts, codes, normalize="full").collect()] == [("001", "X", 3)]
