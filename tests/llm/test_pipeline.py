import corpus_pipeline
from test_decontaminate import words_of
from test_simhash import plain_components, plain_fingerprint

from blotter.llm import packing
from blotter.llm.common import saved, table

SF = "/root/testdata/sf0.01"


def test_stages_hold_against_plain_versions(spark):
    docs, before = table(spark, SF, "documents"), None
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, _ = saved(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == table(spark, SF, "documents").columns
        seen[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()])
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "source_mixing", "token_packing"]

    before, after = seen["toxicity"]
    assert 0 < len(before) - len(after) < 0.2 * len(before) and all(r in before for r in after)

    before, after = seen["simhash_dedup"]
    label = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(label.values()))

    before, after = seen["decontamination"]
    items = [words_of(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    grams = {tuple(ws[i : i + 10]) for ws in items for i in range(max(1, len(ws) - 9)) if ws}
    hit = lambda t: any(tuple(ws[i : i + 10]) in grams for ws in [words_of(t)] for i in range(len(ws) - 9))
    left = {r["doc_id"]: r for r in after}
    for r in before:
        if hit(r["text"]):
            assert r["doc_id"] not in left or left[r["doc_id"]]["n_chars"] == len(left[r["doc_id"]]["text"]) < len(r["text"])
        else:
            assert left[r["doc_id"]] == r

    before, after = seen["source_mixing"]
    times = {}
    for r in after:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3 and set(times) <= {r["doc_id"] for r in before}

    packed = packing.packed(docs).collect()
    encode = packing.encoder().encode_ordinary
    assert sum(r["n_tokens"] for r in packed) == sum(len(encode(r["text"] or "")) + 1 for r in after)
    assert corpus_pipeline.run(spark, SF).count() > 0


NAMES = ["_rate", "_id", "_text", "_severity", "_dc_words", "row", "key", "number", "words", "spans", "part", "x.y", "a`b", "has space"]


def odd_rows(spark):
    """Nulls, repeats and empty texts with columns named like internal ones."""
    base = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35), (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35),
        (None, "alpha beta gamma delta epsilon zeta", None, "s2", None), (None, None, None, None, None), (None, None, None, None, None),
        (2, "", "en", "s1", 0), (3, "w" * 50_000, "en", "s3", 50_000), (3, "another text of the same id", "en", "s3", 27),
        (4, "several words that are in no other text of this small table at all", "de", None, 66),
    ]
    rows = [(*r, *[f"{n} of {i}" for n in NAMES]) for i, r in enumerate(base)]
    kinds = ["doc_id bigint", "text string", "lang string", "source string", "n_chars bigint"]
    quoted = [f"`{n.replace('`', '``')}` string" for n in NAMES]
    return spark.createDataFrame(rows, ", ".join(kinds + quoted))


def test_stages_carry_columns_of_any_name(spark):
    docs = odd_rows(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {tuple(r) for r in docs.collect()}
        docs, _ = saved(stage(spark, docs, SF), f"odd-{name}")
        assert docs.columns == odd_rows(spark).columns
        assert {tuple(r) for r in docs.collect()} <= before
        assert docs.count() > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(len(r["doc_ids"]) for r in packed) >= docs.count()


def test_stages_on_an_empty_table(spark):
    docs = odd_rows(spark).where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = saved(stage(spark, docs, SF), f"empty-{name}")
        assert docs.columns == odd_rows(spark).columns and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Null ids, repeated rows, and an id with texts of two components."""
    from blotter.llm import simhash

    a, b, c = ("one two three four five six seven", "quite other words stand in this second text", "third text of many letters and no copies")
    rows = [(None, a), (None, a), (5, a), (5, a), (5, b), (9, b), (None, c), (None, c), (None, c)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((tuple(r) for r in simhash.first_of_each(docs).collect()), key=str)
    assert got == sorted([(5, a), (5, b), (None, c)], key=str)
