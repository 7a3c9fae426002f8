"""Stored split points, the bounded sample and the line jobs' placement."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from blotter.operators import (
    bottom_k,
    natural_key_sort,
    partition_by_points,
    points_at,
    read_points,
    sample_points,
    string_hash,
    write_points,
)
from blotter.plans import jobs
from blotter.session import scratch_path
from tests.conftest import local


def _partitions(df):
    return [[tuple(r) for r in rows] for rows in df.rdd.glom().collect()]


def test_bottom_k_is_the_same_in_every_layout(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    layouts = [df, df.repartition(7), df.coalesce(1), df.orderBy(F.desc("k"))]
    seen = [sorted(r.k for r in bottom_k(x, F.col("k"), k=40, share=0.5).collect()) for x in layouts]
    assert all(s == seen[0] for s in seen) and len(seen[0]) == 40
    # The sample of fewer rows is part of the sample of more.
    assert set(r.k for r in bottom_k(df, F.col("k"), k=10, share=0.5).collect()) < set(seen[0])
    few = bottom_k(df, F.col("k"), k=1000, share=0.01).count()
    assert 20 < few < 100


def test_bottom_k_holds_no_more_than_k_rows_a_task(spark):
    plan = bottom_k(spark.range(10_000).select(F.col("id").cast("string").alias("k")), F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_points_are_quantiles_and_survive_the_file(spark):
    rows = [(None, "a"), *[(2000 + i % 4, f"{i:03d}") for i in range(99)]]
    df = spark.createDataFrame(rows, "year bigint, iucr string")
    points = sample_points(df, ("year", "iucr"), 5)
    path = scratch_path(spark, "points")
    write_points(points, path)
    stored = read_points(spark, path, df.select("year", "iucr").schema)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [tuple(p) for p in stored] == [ordered[19], ordered[39], ordered[59], ordered[79]]
    # All keys equal: one point; no rows: none.
    assert sample_points(spark.createDataFrame([(1, "x")] * 9, "year bigint, iucr string"), ("year", "iucr"), 5).count() == 1
    assert sample_points(df.where("false"), ("year", "iucr"), 5).count() == 0
    assert sample_points(df, ("year", "iucr"), 1).count() == 0


def test_rows_go_to_the_range_of_their_key(spark):
    rows = [(None, "a"), *[(2001, f"{i:03d}") for i in range(80)], *[(2002, f"{i:03d}") for i in range(20)]]
    df = spark.createDataFrame(rows, "year bigint, iucr string").repartition(6)
    path = scratch_path(spark, "points")
    write_points(sample_points(df, ("year", "iucr"), 4), path)
    points = points_at(df, ("year", "iucr"), 4, path)
    parts = _partitions(partition_by_points(df, ("year", "iucr"), points))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert len(parts) == 4 and sorted(r for p in parts for r in p if r[0]) == sorted(r for r in rows if r[0])
    for i, p in enumerate(parts):
        assert p == sorted(p, key=key)
        for r in p:
            assert sum(key(tuple(b)) < key(r) for b in points) == i
    # The hot year spans partitions.
    assert sum(any(r[0] == 2001 for r in p) for p in parts) >= 3


def test_a_hundred_points(spark):
    df = spark.range(1000).select("id")
    path = scratch_path(spark, "points")
    write_points(sample_points(df, ("id",), 100), path)
    points = read_points(spark, path, df.schema)
    parts = _partitions(partition_by_points(df, ("id",), points))
    assert len(points) == 99 and [len(p) for p in parts] == [10] * 100


def test_arrest_rate_job_keeps_its_split_points(spark, fixture_files, tmp_path):
    points, a, b = (str(tmp_path / n) for n in ("points", "a", "b"))
    stored = spark.createDataFrame([(0, None, "0486"), (1, 2001, "0820"), (2, 2002, "0460")], "point int, year bigint, iucr string")
    write_points(stored, points)
    jobs.arrest_rate(spark, fixture_files["incidents"], a, exact=True, split_points=points)
    files = sorted(f for f in os.listdir(a) if f.startswith("part-"))
    got = [open(os.path.join(a, f)).read().splitlines() for f in files]
    assert sum(map(len, got)) == 7
    # Every key lies above the points before its part and not above its own point.
    bounds = [(False, 0, "0486"), (True, 2001, "0820"), (True, 2002, "0460")]
    for f, rows in zip(files, got):
        part = int(f.split("-")[1])
        for line in rows:
            year, code, _ = line.split(";")
            key = (year not in ("", '""'), int(year) if year.isdigit() else 0, code)
            assert sum(x < key for x in bounds) == part
    # No file yet: the points of a sample are stored, and used again.
    fresh = str(tmp_path / "fresh")
    jobs.arrest_rate(spark, fixture_files["incidents"], b, exact=True, partitions=3, split_points=fresh)
    assert os.path.isdir(fresh)


def java_hash(s: str) -> int:
    h = 0
    raw = s.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) % 2**32
    return h & 0x7FFFFFFF


@pytest.mark.parametrize("n", [1, 7, 20])
def test_natural_key_placement(spark, n):
    keys = ["", "001", "025", "true", "a much longer district name", "é", "日本", "\U0001f600x", None]
    rows = [(k, c) for k in keys for c in range(4)]
    df = spark.createDataFrame(rows, "district string, cnt long").repartition(3)
    hashes = {r.district: r.h for r in df.select("district", string_hash(F.col("district")).alias("h")).collect()}
    assert hashes == {k: java_hash(k or "") for k in keys}
    assert java_hash("hello") == 99162322
    parts = _partitions(natural_key_sort(df, n))
    assert len(parts) == n
    for i, p in enumerate(parts):
        assert all(java_hash(k or "") % n == i for k, _ in p)
        assert p == sorted(p, key=lambda r: ((r[0] or "").lower(), -r[1]))


def test_count_job_in_natural_key_parts(spark, fixture_files, tmp_path):
    out = str(tmp_path / "out")
    jobs.count(spark, fixture_files["incidents"], out, lines=True, partitions=5)
    for f in os.listdir(out):
        if f.startswith("part-"):
            for line in open(os.path.join(out, f)).read().splitlines():
                assert java_hash(line.split(";")[0]) % 5 == int(f.split("-")[1])
    assert local(out) == out
