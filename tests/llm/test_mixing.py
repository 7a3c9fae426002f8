from conftest_llm import rows_of

from blotter.llm import mixing
from blotter.llm.common import table
from blotter.llm.queries import ORACLE_SQL, QUERIES


def plain_targets(sizes):
    """{source: target} by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if 3 * sizes[s] <= level * weight[s]}
        if not above:
            out |= {s: level * weight[s] for s in free}
            break
        out |= {s: 3.0 * sizes[s] for s in above}
        left -= sum(3 * sizes[s] for s in above)
        free -= above
    return out


def test_query_matches_its_sql(spark):
    import duckdb

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        want = sorted(con.execute(ORACLE_SQL["op5_source_mixing"]).fetchall())
        got = sorted(tuple(r) for r in QUERIES["op5_source_mixing"](spark, sf).select("doc_id", "size", "source_size", "target", "taken").collect())
        assert got == want
        assert all(t <= 3 * size for _, size, _, _, t in got)


def test_targets_with_tiny_sources_and_nulls(spark):
    cases = [{"a": 1000, "b": 1, "c": 2, "d": 5, None: 50}, {"a": 0, None: 0}, {"x": 7}, {None: 3, "é": 900, "z": 1, "Z": 2}]
    for sizes in cases:
        frame = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        want = plain_targets(sizes)
        assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_taken_words_come_near_the_target(spark):
    by = {}
    for r in mixing.mix(table(spark, "/root/testdata/sf0.1", "documents")).collect():
        source = by.setdefault(r["source_size"], [r["target"], 0])
        source[1] += r["taken"]
    assert all(abs(taken - target) < 0.12 * target for target, taken in by.values())
    assert abs(sum(t for _, t in by.values()) / sum(t for t, _ in by.values()) - 1) < 0.03


def test_copies_odd_rows_and_columns(spark, odd_documents, no_documents):
    mixed = rows_of(mixing.mix(odd_documents))
    assert len(mixed) == odd_documents.count()
    copies = sorted((str(r["doc_id"]), r["copies"]) for r in mixed for _ in range(r["copies"]))
    frame = mixing.repeated(odd_documents)
    assert frame.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in frame.collect()) == [d for d, _ in copies]
    assert rows_of(mixing.mix(no_documents)) == [] and rows_of(mixing.repeated(no_documents)) == []


def test_null_and_repeated_ids_draw_row_by_row(spark):
    """Rows without an id, and rows equal in all, come near their target too."""
    import duckdb

    texts = [" ".join(f"w{i}" for i in range(10))] * 300
    rows = [(None, f"{t} {i}", "a") for i, t in enumerate(texts)] + [(7, texts[0], "b")] * 400 + [(None, None, "b")] * 5
    rows += [(i, texts[0] * 3, "c") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = rows_of(mixing.mix(docs))
    by = {}
    for r in got:
        by.setdefault(r["target"], []).append(r["taken"])
        assert r["taken"] <= 3 * r["size"]
    assert len(got) == len(rows) and len(by) == 3
    assert all(abs(sum(taken) - target) < 0.12 * target for target, taken in by.items())
    assert mixing.repeated(docs).count() == sum(r["copies"] for r in got)
    # Another layout gives the same rows, and so does the SQL.
    key = lambda r: tuple(str(v) for v in r)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    again = sorted((tuple(r[c] for c in columns) for r in rows_of(mixing.mix(docs.repartition(3)))), key=key)
    assert again == sorted((tuple(r[c] for c in columns) for r in got), key=key)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert again == sorted(con.execute(ORACLE_SQL["op5_source_mixing"]).fetchall(), key=key)
