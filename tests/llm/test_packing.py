import random

import numpy as np
from conftest_llm import rows_of

from blotter.llm import packing
from blotter.llm.common import table


def check(df, texts, capacity=packing.ROW_TOKENS):
    """An exact round trip: every document's pieces in order spell its text."""
    encode, pieces, used = packing.encoder(), {}, []
    for r in df.collect():
        ids = np.frombuffer(r["input_ids"], "<u2")
        places = np.frombuffer(r["position_ids"], "<u2")
        ends = r["cu_seqlens"]
        assert len(ids) == len(places) == capacity and ends[0] == 0 and ends[-1] == r["n_tokens"] <= capacity
        assert (ids[ends[-1] :] == packing.END).all()
        for doc, k, a, b in zip(r["doc_ids"], r["pieces"], ends, ends[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            pieces.setdefault(doc, []).append((k, ids[a:b].tolist()))
        used.append(r["n_tokens"])
    got = {}
    for doc, found in pieces.items():
        starts = [t for k, t in sorted(found, key=lambda p: p[0])]
        got[doc] = [x for t in starts for x in t]
    assert set(got) == {d for d, _ in texts}
    for doc, text in texts:
        assert got[doc] == [*encode.encode_ordinary(text or ""), packing.END]
    return used


def test_round_trip_of_whole_texts(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    used = check(packing.packed(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(used) > 0.9 * packing.ROW_TOKENS * (len(used) - 1)


def test_odd_texts_and_small_rows(spark, odd_documents, no_documents):
    odd = odd_documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(packing.packed(odd, row_tokens=64), [(r["doc_id"], r["text"]) for r in odd.collect()], 64)
    texts = [(i, t) for i, t in enumerate(["  two  spaces ", "a \n b\n\n c", " lead", "tail ", "x y z", "<|endoftext|> is text", "\t a"])]
    check(packing.packed(spark.createDataFrame(texts, "doc_id bigint, text string")), texts)
    assert rows_of(packing.packed(no_documents)) == []


def test_best_fit_decreasing_against_a_plain_search():
    rnd = random.Random(0)
    for _ in range(100):
        capacity = rnd.randint(1, 40)
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 60))]
        free = []
        for n in sorted(lengths, reverse=True):
            fits = [s for s in free if s >= n]
            if fits:
                free.remove(min(fits))
            free.append((min(fits) if fits else capacity) - n)
        rows = packing.best_fit_decreasing(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def test_null_and_repeated_ids_lose_no_token(spark):
    texts = [None, "", "one two", "one two", "ünï " * 40]
    rows = [(None, t) for t in texts] + [(3, t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    encode = packing.encoder()
    found = []
    for r in packing.packed(docs, row_tokens=16).collect():
        ids = np.frombuffer(r["input_ids"], "<u2")
        for doc, k, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            found.append((doc, k, ids[a:b].tolist()))
    want = []
    for doc, text in rows:
        ids = [*encode.encode_ordinary(text or ""), packing.END]
        want += [(doc, k, ids[i : i + 16]) for k, i in enumerate(range(0, len(ids), 16))]
    assert sorted(found, key=str) == sorted(want, key=str)
