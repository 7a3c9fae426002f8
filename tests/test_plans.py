"""Physical plan shapes that matter at scale."""

from __future__ import annotations

import os

import pytest

from blotter.plans.catalog import QUERIES
from blotter.operators import join_lookup
from tests.conftest import SMOKE_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="driver tables missing")


def plan(df) -> str:
    """Executed physical plan (final adaptive plan) as text."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_nodes(spark, name):
    text = initial_plan(QUERIES[name](spark, SMOKE_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product_and_no_row_cap(spark, name):
    """Whole results: no cross join of two inputs, no limit on any query."""
    text = initial_plan(QUERIES[name](spark, SMOKE_DIR))
    # The bounded sample is the feature of this one.
    capped = () if name == "split_points_sample" else ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject")
    for node in ("CartesianProduct", *capped):
        assert node not in text


def test_tagged_union_is_one_exchange_without_a_join(spark):
    from blotter.operators import tagged_union_join

    counts = spark.range(100).selectExpr("cast(id % 9 as string) iucr", "'1' district", "id cnt").repartition(3)
    lookup = spark.range(9).selectExpr("cast(id as string) iucr", "'d' description").repartition(2)
    text = initial_plan(tagged_union_join(counts, lookup))
    assert "Join" not in text and text.count("hashpartitioning") == 1


def test_one_scan_join_scans_once(spark):
    text = initial_plan(QUERIES["one_scan_join"](spark, SMOKE_DIR))
    assert text.count("FileScan") == 1 and "Join" not in text


@pytest.mark.parametrize("name", ["type_count_by_district", "type_count_left_join", "arrest_pct"])
def test_partial_aggregation_before_shuffle(spark, name):
    text = initial_plan(QUERIES[name](spark, SMOKE_DIR))
    assert "partial_count" in text or "partial_avg" in text


def test_broadcast_variant_uses_broadcast_hash_join(spark):
    text = plan(QUERIES["type_count_broadcast_join"](spark, SMOKE_DIR))
    assert "BroadcastHashJoin" in text


def test_aggregate_below_join(spark):
    text = initial_plan(QUERIES["type_count_left_join"](spark, SMOKE_DIR))
    join_at = text.index("HashJoin") if "HashJoin" in text else text.index("Join")
    # The final count aggregate appears below (after, in the tree text) the join.
    assert "HashAggregate" in text[join_at:]


def test_single_final_range_exchange(spark):
    text = initial_plan(QUERIES["type_count_by_district"](spark, SMOKE_DIR))
    assert text.count("rangepartitioning") == 1


def test_tagged_cogroup_is_reduce_side(spark):
    text = plan(QUERIES["tagged_cogroup_join"](spark, SMOKE_DIR))
    assert "SortMergeJoin" in text
    assert "BroadcastHashJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = initial_plan(QUERIES["type_count_inner_join"](spark, SMOKE_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_broadcast_strategy_falls_back_to_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = spark.createDataFrame([("a", "1", 2)], "iucr string, district string, cnt long")
        lookup = spark.range(50).selectExpr("cast(id as string) as iucr", "'d' as description")
        df = join_lookup(counts, lookup, how="left", strategy="broadcast")
        text = plan(df)
        assert "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_strategy_measures_the_lookup(spark, monkeypatch):
    """Asked for, a lookup above Spark's own threshold is broadcast too, but not
    one above the library's bound."""
    from blotter.operators import joins

    counts = spark.range(5000).selectExpr("cast(id as string) iucr", "'1' district", "id cnt")
    lookup = spark.range(5000).selectExpr("cast(id as string) iucr", "repeat('d', 50) description")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert "BroadcastHashJoin" in initial_plan(join_lookup(counts, lookup, strategy="broadcast"))
        assert "BroadcastHashJoin" not in initial_plan(join_lookup(counts, lookup))
        assert joins.small_enough(lookup, 1 << 20) and not joins.small_enough(lookup, 100_000)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 100_000)
        assert "BroadcastHashJoin" not in initial_plan(join_lookup(counts, lookup, strategy="broadcast"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
