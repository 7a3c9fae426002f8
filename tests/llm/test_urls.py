import os

import duckdb
import pytest

from blotter.llm import queries, urls
from blotter.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{name}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_conversation_trie", "op13_url_filters"])
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    want = [tuple(r[columns.index(c)] for c in df.columns) for r in cursor.fetchall()]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.collect())


URLS = [
    ("http://A.Example.NET/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/enx", "example.net", "/enx", "net/", "block"),
    ("http://xexample.net/en/1", "xexample.net", "/en/1", "net/", "block"),
    ("https://net", "net", "", None, "allow"),
    ("https://net/", "net", "/", "net/", "block"),
    ("ftp://a.example.com/de/?q=://x", "a.example.com", "/de/", "example.com/de/", "block"),
    ("http://x.org/fr/#top?x", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://x.org?/fr/", "x.org", "", None, "allow"),
    ("http://ÄÉ.NET\n/x", "ÄÉ.net\n", "/x", None, "allow"),
    ("no scheme/net/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u[0], "x", 1.0, 5) for i, u in enumerate(URLS)] + [(None, URLS[0][0], "x", 1.0, 5)] * 2
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string, confidence double, held int")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judged(df).collect()}
    assert len(rows) == urls.judged(df).count()
    for i, u in enumerate(URLS):
        assert got[i] == (*u[1:], None), u[0]
    assert got[None] == (*URLS[0][1:], None)


def test_no_rows(spark):
    assert urls.judged(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def pages_of(spark, addresses):
    return spark.createDataFrame(list(enumerate(addresses)), "page_id bigint, url string")


def test_mined_rules_block_like_combinations(spark):
    """What the blocked urls share, and no allowed one, blocks elsewhere; what
    they share only with the rule's own host does not."""
    addresses = [f"http://a{i}.example.com/de/cheap/{i}" for i in range(40)]
    addresses += [f"http://b{i}.example.net/en/cheap/{i}" for i in range(40)]
    addresses += ["http://c.org/de/cheap/1", "http://c.example.org/de/cheap/77", "http://c.example.org/en/cheap/3", "http://example.com/fr/"]
    got = [r["verdict"] for r in urls.judged(pages_of(spark, addresses)).orderBy("page_id").collect()]
    assert got[:80] == ["block"] * 40 + ["allow"] * 40
    assert got[80:] == ["allow", "allow", "allow", "allow"]
    more = addresses + [f"http://d{i}.example.net/de/cheap/{i}" for i in range(40)]
    got = {r["url"]: (r["verdict"], r["mined"]) for r in urls.judged(pages_of(spark, more)).join(pages_of(spark, more), "page_id").collect()}
    assert got["http://c.example.org/de/cheap/77"][0] == "block" and "path de" in got["http://c.example.org/de/cheap/77"][1]
    assert got["http://c.org/de/cheap/1"] == ("allow", None)


def test_main_path_has_no_python(spark):
    plan = urls.judged(table(spark, SF, "pages"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
