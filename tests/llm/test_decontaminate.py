import hashlib
import random
import re

from conftest_llm import rows_of

from blotter.llm import decontaminate as dc
from blotter.llm.common import table
from blotter.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    where = {}
    for item, text in items:
        ws = words_of(text)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            where.setdefault(tuple(ws[i : i + n]), set()).add(item)
    sizes = sorted({len(w) for w in where})
    out = []
    for doc, text in docs:
        ws, hit, found = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if (ids := where.get(tuple(ws[i : i + n]))):
                    found |= ids
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()), key=str
    )


def test_query_against_every_window(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
        items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
        want = plain(docs, items)
        assert got(QUERIES["op8_decontamination"](spark, sf)) == want and any(w[5] for w in want)


def random_case(seed):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, n)))
    return [(i, text(40)) for i in range(30)], [(i % 9, text(14)) for i in range(12)]


def test_automaton_on_small_alphabets():
    for seed in range(60):
        docs, items = random_case(seed)
        machine = dc.Automaton([(str(i), dc.normal_words(t.encode())) for i, t in items], 4)
        want = plain(docs, items, 4)
        for doc, text in docs:
            spans, found = machine.match(dc.normal_words(text.encode()))
            row = next(w for w in want if w[0] == doc)
            assert (sum(b - a for a, b in spans), len(found)) == (row[2], row[3])


def test_blocks_and_odd_rows(spark, odd_documents, no_documents):
    docs, items = random_case(99)
    frame = spark.createDataFrame([*docs, (None, None), (50, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([*items, (77, None)], "item_id bigint, text string")
    assert got(dc.hits(frame, bench, 4, 15)) == plain([*docs, (None, None), (50, "")], items, 4)
    empty = bench.limit(0)
    assert not any(r["contaminated"] for r in dc.hits(odd_documents, empty).collect())
    assert rows_of(dc.hits(no_documents, bench)) == [] and rows_of(dc.cleaned(no_documents, bench)) == []
    assert dc.cleaned(odd_documents, bench).columns == odd_documents.columns


def test_cleaned_cuts_spans_and_keeps_clean_rows(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [
        (1, f"Before, it starts. {item.upper()}! And this is what comes after the passage, with many more words here", 9, "src"),
        (2, item, 9, "src"), (3, "a clean text", 9, None), (4, None, None, "src"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, source string")
    bench = spark.createDataFrame([("q", item)], "item_id string, text string")
    left = {r["doc_id"]: r for r in dc.cleaned(frame, bench).collect()}
    assert set(left) == {1, 3, 4}
    assert left[1]["text"] == "Before, it starts. ! And this is what comes after the passage, with many more words here"
    assert left[1]["n_chars"] == len(left[1]["text"])
    assert left[3].asDict() == dict(zip(frame.columns, rows[2])) and left[4]["text"] is None


def test_blocks_hold_all_items_within_their_bound(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate((3, 30, 120, 0, 7, 55, 90, 1))]
    bench = spark.createDataFrame(items, "item_id bigint, text string").repartition(7)
    rows = dc.blocks(bench, 10, 50).collect()
    sizes = [sum(len(bytes(p["words"]).split()) for p in r["items"]) for r in rows]
    assert max(sizes) <= 50 and len({r["block"] for r in rows}) == len(rows) <= 2 * -(-sum(sizes) // 50)
    pieces = [(p["item_id"], bytes(p["words"]).split()) for r in rows for p in r["items"]]
    for i, text in items:
        words = dc.normal_words(text.encode())
        held = {tuple(w[k : k + 10]) for item, w in pieces if item == str(i) for k in range(max(1, len(w) - 9))}
        assert held == {tuple(words[k : k + 10]) for k in range(max(1, len(words) - 9)) if words}


def test_cleaning_by_several_blocks_equals_one(spark):
    docs, items = random_case(5)
    frame = spark.createDataFrame([(d, t, len(t), "x", "y") for d, t in docs] * 2, "doc_id bigint, text string, n_chars bigint, key string, words string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(str, dc.cleaned(frame, bench, 4, 0.9).collect()))
    assert one == sorted(map(str, dc.cleaned(frame, bench, 4, 0.9, block_words=15).collect())) and 0 < len(one)
