import hashlib
import random

import numpy as np
from conftest_llm import rows_of

from blotter.llm import rlz
from blotter.llm.common import table
from blotter.llm.queries import QUERIES


def plain(docs, window=20):
    """{(id, words): (n, removed, sha)} by looking every window up."""
    places, texts = {}, []
    for doc, text in docs:
        words = (text or "").encode().split()
        texts.append((doc, words))
        key = float("inf") if doc is None else doc
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            places[w] = min(places.get(w, (key, i)), (key, i))
    out = []
    for doc, words in texts:
        gone = [False] * len(words)
        key = float("inf") if doc is None else doc
        for i in range(len(words) - window + 1):
            if places[tuple(words[i : i + window])] < (key, i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_query_against_every_window(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
        want = plain(docs)
        assert got(QUERIES["op6_substring_dedup"](spark, sf)) == want
        assert sum(n for _, _, n, _ in want)


def test_small_alphabet_and_blocks(spark, monkeypatch):
    """Texts that repeat each other and themselves in every way."""
    rnd = random.Random(1)
    docs = []
    pool = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(5, 60))) for _ in range(12)]
    for i in range(120):
        docs.append((rnd.choice([i, i, i, 7, None]), "  ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 5)))))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for window, anchor in ((20, 10), (6, 3), (4, 4)):
        assert got(rlz.deduplicated(frame, window, anchor)) == plain(docs, window)


def test_factors_are_copies(spark):
    docs = {r["doc_id"]: r["text"].split() for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    seen = 0
    for r in rlz.deduplicated(table(spark, "/root/testdata/sf0.001", "documents")).collect():
        for f in r["factors"]:
            a = docs[r["doc_id"]][f["start"] : f["start"] + f["words"]]
            b = docs[f["source"]][f["source_start"] : f["source_start"] + f["words"]]
            assert a == b and len(a) >= 20
            assert (f["source"], f["source_start"]) < (r["doc_id"], f["start"])
            seen += 1
    assert seen


def test_hash_helpers():
    rnd = np.random.default_rng(0)
    g = rnd.integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 11, 20):
        assert rlz.least(g, width).tolist() == [min(g[i : i + width]) for i in range(201 - width)]
        h = rlz.rolled(g, width)
        assert len(h) == 201 - width
        same = {}
        for i, x in enumerate(h.tolist()):
            same.setdefault(tuple(g[i : i + width].tolist()), set()).add(x)
        assert all(len(v) == 1 for v in same.values()) and len({x for v in same.values() for x in v}) == len(same)


def test_windows_of_a_hot_anchor_that_agree_in_32_bits(spark):
    """One phrase in many surroundings: two windows whose hashes fold to the
    same 32 bits are no copies, in one block or in two."""
    rnd = np.random.default_rng(3)
    words = [f"w{i}" for i in range(1000)]
    of = rlz.hashed([w.encode() for w in words])
    phrases = rnd.integers(0, 1000, (20_000, 10))
    phrase = phrases[np.argmin([rlz.rolled(of[p], 10)[0] for p in phrases])]
    picked = np.concatenate([np.tile(phrase, (300_000, 1)), rnd.integers(0, 1000, (300_000, 10))], axis=1)
    whole, low = rlz.rolled(of[picked].ravel(), 20)[::20], rlz.least(rlz.rolled(of[picked].ravel(), 10), 11)[::20]
    at = np.flatnonzero(low == rlz.rolled(of[phrase], 10)[0])
    folded = (whole ^ (whole >> np.uint64(32))).astype(np.uint32)[at]
    order = np.argsort(folded, kind="stable")
    twin = np.flatnonzero(np.diff(folded[order]) == 0)
    docs = []
    for i in twin:
        for k in (at[order[i]], at[order[i + 1]]):
            docs.append((len(docs), " ".join(words[w] for w in picked[k])))
    assert docs
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for parts in (1, 2 * len(docs)):
        assert got(rlz.deduplicated(frame.repartitionByRange(parts, "doc_id"))) == plain(docs)


def test_a_phrase_in_many_surroundings(spark, monkeypatch):
    """A hot anchor: its windows are dealt over keys, and a task holds the
    distinct windows of a key only."""
    monkeypatch.setattr(rlz, "HOT_PLACES", 64)
    rnd = random.Random(7)
    phrase = " ".join(f"p{i}" for i in range(14))
    side = [" ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(30)}" for _ in range(9)) for _ in range(900)]
    docs = [(i, f"{side[i]} {phrase} {side[(7 * i) % 900]}") for i in range(900)]
    docs += [(1000 + i, docs[rnd.randrange(900)][1]) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    assert got(rlz.deduplicated(frame)) == plain(docs)
    blocks, _ = rlz.saved(rlz.word_blocks(frame), "test-blocks")
    anchors = blocks.mapInArrow(rlz._anchors(20, 10), "anchor bigint, block bigint, places int")
    assert rlz.repeated_anchors(anchors).agg({"total": "max"}).first()[0] > 64


def test_a_key_over_several_batches(spark, monkeypatch):
    """Distinct windows are carried from batch to batch of one key."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_a_phrase_in_many_surroundings(spark, monkeypatch)
        monkeypatch.setattr(rlz, "HOT_PLACES", 1 << 15)
        rnd = random.Random(2)
        pool = [" ".join(rnd.choice("abc") for _ in range(40)) for _ in range(6)]
        docs = [(i, " ".join(rnd.choice(pool) for _ in range(3))) for i in range(90)]
        frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(30)
        assert got(rlz.deduplicated(frame)) == plain(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark, odd_documents, no_documents):
    frame = odd_documents.withColumnRenamed("rate", "block")
    want = plain([(r["doc_id"], r["text"]) for r in odd_documents.collect()])
    assert got(rlz.deduplicated(frame)) == want
    assert rows_of(rlz.deduplicated(no_documents)) == []
