"""Every registered query against its SQL oracle on DuckDB (sf0.001)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__
from __spark_entry__ import entry
from blotter.plans.catalog import QUERIES
from blotter.plans.oracle import oracle_sql
from tests.conftest import SMOKE_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="driver tables missing")


def _norm(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _sort_key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_is_registered_with_an_oracle_or_rows_only():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(oracle_sql()) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["district", "description", "cnt"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(got) == len(want)
    assert sorted(got, key=_sort_key) == sorted(want, key=_sort_key)


def test_split_points_shape(spark):
    row = QUERIES["split_points"](spark, SMOKE_DIR).collect()
    assert len(row) == 1
    points = row[0]["split_points"].split(",")
    assert len(points) == 8 and points == sorted(points)
