"""Scratch directory and the prepared tables."""

from __future__ import annotations

import os

import pytest

from blotter.session import scratch_dir, scratch_path
from blotter.sources import tpch
from tests.conftest import SMOKE_DIR, local

needs_tables = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="driver tables missing")


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    base = scratch_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base + "/") and b.startswith(base + "/")


@needs_tables
def test_text_files_are_kept_until_the_input_changes(spark, tmp_path):
    import shutil

    for t in ("lineitem", "part"):
        shutil.copy(f"{SMOKE_DIR}/{t}.parquet", tmp_path / f"{t}.parquet")
    src = str(tmp_path)
    text = tpch.prepare_text(spark, src)
    assert tpch.prepare_text(spark, src + "/") == text
    assert set(text) == {"extract", "extract_nodesc", "codes"}
    before = tpch.incidents(spark, src).count()
    os.remove(tmp_path / "lineitem.parquet")
    spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").limit(100).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert before > 100
    spark.catalog.refreshByPath(src)
    assert tpch.prepare_text(spark, src) != text
    assert tpch.incidents(spark, src).count() == 100


@needs_tables
def test_building_a_query_leaves_no_file_and_release_removes_text_files(spark):
    from blotter.plans.catalog import QUERIES

    tpch.release(spark)
    base = local(scratch_dir(spark))
    before = set(os.listdir(base))
    for name in ("type_count_by_district", "type_count_left_join", "arrest_pct", "split_points", "code_normalize"):
        if name != "code_normalize":
            QUERIES[name](spark, SMOKE_DIR)
    assert set(os.listdir(base)) == before
    paths = tpch.prepare_text(spark, SMOKE_DIR)
    assert all(os.path.isdir(local(p)) for p in paths.values())
    tpch.release(spark)
    assert not any(os.path.isdir(local(p)) for p in paths.values())


def _text_files_of(spark, query):
    """The text inputs that a query has written, by the names of their folders."""
    from blotter.plans.catalog import QUERIES

    tpch.release(spark)
    base = local(scratch_dir(spark))
    before = set(os.listdir(base))
    QUERIES[query](spark, SMOKE_DIR)
    return sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(base)) - before)


@needs_tables
@pytest.mark.parametrize("query", ["key_value_line_parse"])
def test_line_counts_write_only_the_extract_they_read(spark, query):
    assert _text_files_of(spark, query) == ["damaged", "extract_nodesc"]


@needs_tables
@pytest.mark.parametrize("query", ["one_scan_join", "tagged_cogroup_join", "tagged_union_join"])
def test_line_joins_write_only_the_extract_and_the_lookup(spark, query):
    assert _text_files_of(spark, query) == ["codes", "damaged", "extract_nodesc"]


@needs_tables
def test_extracts_are_written_packed_in_files_of_bounded_rows(spark, monkeypatch):
    import gzip

    tpch.release(spark)
    monkeypatch.setitem(tpch.EXTRACT_FILES, "maxRecordsPerFile", 1000)
    n = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet").count()
    for name in ("extract", "extract_nodesc"):
        path = tpch.text_file(spark, SMOKE_DIR, name)
        files = [f"{local(path)}/{f}" for f in os.listdir(local(path)) if f.startswith("part-")]
        lines = [gzip.open(f, "rt").read().splitlines() for f in files]
        assert all(f.endswith(".csv.gz") for f in files) and all(len(one) <= 1001 for one in lines)
        assert {one[0].split(";")[4] for one in lines} == {"IUCR"}
        assert sum(len(one) - 1 for one in lines) == n == spark.read.text(path).where("value NOT LIKE 'ID;%'").count()
        plain = sum(len(line) + 1 for one in lines for line in one)
        assert 2 * sum(map(os.path.getsize, files)) < plain
    tpch.release(spark)


def _own_tables(spark, path):
    """Codes with no, one and several lookup entries, and null codes on both sides."""
    spark.sql(
        "SELECT id l_orderkey, CAST(1 AS INT) l_linenumber, IF(id % 7 = 0, NULL, id % 5) l_partkey, id l_suppkey, 'R' l_returnflag,"
        " TIMESTAMP_NTZ '1995-01-02 00:00:00' l_shipdate FROM range(1, 100)"
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.sql(
        "SELECT CAST(k AS BIGINT) p_partkey, 't' p_type, n p_name FROM"
        " VALUES (0, 'a'), (1, 'b'), (1, 'c'), (1, 'c'), (2, NULL), (2, 'd'), (3, 'e'), (NULL, 'f'), (NULL, 'g') v(k, n)"
    ).write.parquet(f"{path}/part.parquet")
    return str(path)


@pytest.mark.parametrize("threshold", ["10MB", "1", "-1"])
def test_incidents_without_descriptions_come_as_often_as_with_them(spark, tmp_path, threshold):
    src, columns = _own_tables(spark, tmp_path), ("iucr", "arrest", "district", "year")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = sorted(map(tuple, tpch.incidents_without_descriptions(spark, src).collect()), key=str)
        want = sorted(map(tuple, tpch.incidents(spark, src).select(*columns).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and len(got) > 99 and any(r[0] is None for r in got)


@needs_tables
def test_a_lookup_above_the_broadcast_size_shuffles_no_incidents(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plans = [f(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
                 for f in (tpch.incidents, tpch.incidents_without_descriptions)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ["SortMergeJoin" in p for p in plans] == [True, False] and "BroadcastHashJoin" in plans[1]


@needs_tables
def test_lookup_has_every_part_and_unique_codes(spark):
    n = spark.read.parquet(f"{SMOKE_DIR}/part.parquet").count()
    for lookup in (tpch.codes(spark, SMOKE_DIR), tpch.shipped_codes(spark, SMOKE_DIR)):
        assert lookup.count() == lookup.select("iucr").distinct().count() == n
