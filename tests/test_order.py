"""Ordering and partition layout (invisible to an order-insensitive hash)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from blotter.operators import hash_partition, key_faults, order_faults, range_sort, split_points
from blotter.plans.catalog import QUERIES
from blotter.sinks import export_single_file
from blotter.session import scratch_path
from tests.conftest import SMOKE_DIR, local

needs_tables = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="driver tables missing")


def _district_key(d):
    return (d is not None, d or "")


@needs_tables
def test_global_order_district_then_count(spark):
    got = [tuple(r) for r in QUERIES["type_count_by_district"](spark, SMOKE_DIR).collect()]
    keys = [(_district_key(d), -c) for d, _, c in got]
    assert keys == sorted(keys)


@needs_tables
def test_global_order_after_join(spark):
    got = [tuple(r) for r in QUERIES["type_count_left_join"](spark, SMOKE_DIR).collect()]
    keys = [(_district_key(d), -c) for d, _, c in got]
    assert keys == sorted(keys)


@needs_tables
def test_case_insensitive_order(spark):
    got = [tuple(r) for r in QUERIES["type_count_by_district_clean"](spark, SMOKE_DIR).collect()]
    keys = [((d or "").lower(), -c) for d, _, c in got]
    assert keys == sorted(keys)


def test_case_insensitive_order_mixed_case(spark):
    df = spark.createDataFrame(
        [("b", "x", 1), ("A", "y", 5), ("a", "z", 7), (None, "w", 2)],
        "district string, description string, cnt long",
    )
    from blotter.operators import order_by_district_count

    got = [r.district for r in order_by_district_count(df, case_insensitive=True).collect()]
    assert got == [None, "a", "A", "b"]


@needs_tables
def test_year_order(spark):
    years = [r.year for r in QUERIES["arrest_pct"](spark, SMOKE_DIR).collect()]
    assert years == sorted(years)


def _partitions(df):
    return df.rdd.glom().map(lambda rows: [tuple(r) for r in rows]).collect()


@needs_tables
def test_range_partitioned_sort(spark):
    df = QUERIES["arrest_pct_range_sorted"](spark, SMOKE_DIR).select("year", "iucr")
    parts = [p for p in _partitions(df) if p]
    assert len(parts) > 1
    for p in parts:
        assert p == sorted(p, key=_nulls_first)
    for a, b in zip(parts, parts[1:]):
        assert _nulls_first(a[-1]) <= _nulls_first(b[0])


def _nulls_first(row):
    return tuple((v is not None, v or 0) if i == 0 else v for i, v in enumerate(row))


def test_range_sort_splits_a_hot_key(spark):
    # One year holds most rows; the tie-breaker lets it span partitions.
    rows = [("2001", f"{i:04d}") for i in range(300)] + [("2002", "0001")]
    df = spark.createDataFrame(rows, "year string, iucr string")
    parts = [p for p in _partitions(range_sort(df, 4, ("year", "iucr"))) if p]
    hot = [p for p in parts if any(r[0] == "2001" for r in p)]
    assert len(hot) > 1


@needs_tables
def test_secondary_sort_partition_layout(spark):
    df = QUERIES["type_count_secondary_sort"](spark, SMOKE_DIR)
    parts = _partitions(df)
    seen = {}
    for i, p in enumerate(parts):
        keys = [((d or "").lower(), -c) for d, _, c in p]
        assert keys == sorted(keys)
        for d, _, _ in p:
            assert seen.setdefault(d, i) == i  # one district -> one partition


def test_hash_partition_keeps_keys_together(spark):
    df = spark.createDataFrame([(str(i % 7), i) for i in range(200)], "district string, v long")
    parts = _partitions(hash_partition(df, 5))
    owner = {}
    for i, p in enumerate(parts):
        for d, _ in p:
            assert owner.setdefault(d, i) == i


def test_single_file_export(spark, tmp_path):
    df = spark.createDataFrame([(str(i), i) for i in range(50)], "k string, v long").repartition(4)
    out = scratch_path(spark, "single")
    export_single_file(df.orderBy("v"), out)
    parts = [f for f in os.listdir(local(out)) if f.startswith("part-")]
    assert len(parts) == 1
    written = open(os.path.join(local(out), parts[0])).read().split()
    assert written == [f"{i};{i}" for i in range(50)]


def test_split_points_exact_on_full_sample(spark):
    df = spark.createDataFrame([(str(1995 + i % 7), str(i)) for i in range(7000)], "year string, k string")
    row = split_points(df, "year", 7, "k", fraction=1.0).collect()[0]
    # Upper bounds: partition i holds keys <= split i (range partitioner convention).
    assert row["split_points"] == "1995,1996,1997,1998,1999,2000"
    assert row["sampled_rows"] == 7000


def test_order_faults_counts_inversions_and_boundaries(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "v long")
    v = F.col("v")
    good = order_faults(range_sort(df, 4, ("v",)), v).first()
    assert tuple(good) == (100, 0, 0)
    inside = order_faults(df.coalesce(1).sortWithinPartitions(F.desc("v")), v).first()
    assert tuple(inside) == (100, 99, 0)
    falling = order_faults(df.repartitionByRange(4, F.desc("v")).sortWithinPartitions("v"), v).first()
    assert tuple(falling) == (100, 0, 3)
    assert tuple(order_faults(df.where("v < 0"), v).first()) == (0, 0, 0)


def test_key_faults_counts_split_keys(spark):
    df = spark.createDataFrame([(str(i % 7), i) for i in range(200)], "district string, v long")
    assert tuple(key_faults(hash_partition(df, 5), 5, "district").first()) == (7, 0, 0)
    assert key_faults(df.repartition(5), 5, "district").first()["split_keys"] == 7
    assert key_faults(df.repartition(5), 1, "district").first()["partitions_over"] == 7
