import random

import numpy as np
import xxhash
from conftest_llm import rows_of

from blotter.llm import simhash
from blotter.llm.common import table
from blotter.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    """{key: smallest key reachable} over (key, fingerprint) pairs."""
    by = {}
    for k, f in prints:
        by.setdefault(f, []).append(k)
    values = np.array(list(by), dtype=np.uint64)
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= distance):
            a, b = sorted((root(i), root(int(j))))
            label[b] = a
    least = {}
    for i, v in enumerate(values):
        least.setdefault(root(i), []).extend(by[int(v)])
    return {k: min(ks) for ks in least.values() for k in ks}


def test_query_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, MIDDLE, "documents").select("doc_id", "text").collect()]
    prints = {d: plain_fingerprint(t) for d, t in docs}
    want = plain_components(prints.items())
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op9_simhash_dedup"](spark, MIDDLE).collect()}
    assert got == {d: (f"{f:016x}", want[d]) for d, f in prints.items()}
    assert len(set(want.values())) < len(want)


def dense(n, seed):
    """Fingerprints in crowded balls, in chains and alone."""
    rnd = random.Random(seed)
    out = []
    for _ in range(6):
        centre = rnd.getrandbits(64)
        weak = rnd.sample(range(64), 14)
        out += [centre ^ sum(1 << b for b in weak if rnd.random() < 0.35) for _ in range(n)]
    x = rnd.getrandbits(64)
    for _ in range(n):
        x ^= sum(1 << b for b in rnd.sample(range(64), 4))
        out.append(x)
    return out + [rnd.getrandbits(64) for _ in range(n)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def linked(spark, values, monkeypatch=None):
    frame = spark.createDataFrame([(signed(v),) for v in sorted(set(values))], "fp bigint")
    edges = [(r["u"], r["v"]) for r in simhash.links(frame).collect()]
    assert all(int.bit_count((u ^ v) & (2**64 - 1)) <= 4 for u, v in edges)
    label = {signed(v): signed(v) for v in values}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        label[b] = a
    groups = {}
    for v in label:
        groups.setdefault(root(v), set()).add(v)
    return {frozenset(g) for g in groups.values()}, len(edges)


def plain_groups(values):
    want = {}
    for k, c in plain_components([(signed(v), v) for v in set(values)]).items():
        want.setdefault(c, set()).add(k)
    return {frozenset(g) for g in want.values()}


def test_links_connect_all(spark):
    values = dense(400, 1)
    got, _ = linked(spark, values)
    assert got == plain_groups(values)


def test_forest_is_no_larger_than_its_nodes():
    values = np.array([signed(v) for v in set(dense(300, 5))], np.int64)
    own, guests = values[::2], values[1::2]
    u, v = simhash.forest(own, guests, 4)
    assert len(u) == len(v) <= len(values)
    label = {int(x): int(x) for x in values}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in zip(u.tolist(), v.tolist()):
        assert int.bit_count((a ^ b) & (2**64 - 1)) <= 4
        label[root(a)] = root(b)
    for x in own.tolist():
        for y in values[simhash._apart(values, np.int64(x)) <= 4].tolist():
            assert root(x) == root(y)


def test_hot_values_are_dealt_and_lose_nothing(spark, monkeypatch):
    values = dense(300, 2)
    monkeypatch.setattr("blotter.llm.common.HOT_ROWS", 20)
    monkeypatch.setattr(simhash, "BLOCKS", 4)
    got, _ = linked(spark, values)
    assert got == plain_groups(values)


def test_blocks_follow_the_size_of_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr("blotter.llm.common.HOT_ROWS", 20)
    monkeypatch.setattr(simhash, "BLOCKS", 2)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 50)
    entries = spark.range(2010).selectExpr("if(id < 2000, 7, 8) as key", "id as fp", "true as own")
    assert max(r["count"] for r in simhash.dealt(entries).groupBy("key").count().collect()) < 200
    values = dense(150, 6)
    got, _ = linked(spark, values)
    assert got == plain_groups(values)


def test_every_plan_finds_all(spark):
    values = dense(60, 3)
    sample = np.array([signed(v) for v in values], np.int64)
    for n in (10, 10_000, 10_000_000):
        plan = simhash.plan_search(sample, n, 4)
        assert sum(t + 1 for _, t in plan) == 5
        assert len({b for bits, _ in plan for b in bits}) == sum(len(bits) for bits, _ in plan)


def test_allocate_is_optimal():
    rnd = random.Random(4)
    for _ in range(50):
        costs = [[0.0, *(rnd.random() for _ in range(5))] for _ in range(3)]
        best = min(
            costs[0][a] + costs[1][b] + costs[2][5 - a - b] for a in range(6) for b in range(6 - a) if 5 - a - b <= 5
        )
        assert abs(simhash.allocate(costs, 5)[0] - best) < 1e-12


def test_odd_rows(spark, odd_documents, no_documents):
    got = rows_of(simhash.near_duplicates(odd_documents))
    assert len(got) == odd_documents.count()
    of = {r["doc_id"]: r for r in got}
    assert {of[i]["fingerprint"] for i in (2, 3, 4)} == {"0" * 16} and {of[i]["component_id"] for i in (2, 3, 4)} == {2}
    assert of[None]["component_id"] == 1 and of[6]["component_id"] == 6
    kept = [r["doc_id"] for r in simhash.first_of_each(odd_documents).collect()]
    assert sorted(kept) == [1, 2, 5, 6, 7]  # the row without an id is a copy of row 1
    assert simhash.first_of_each(odd_documents).columns == odd_documents.columns
    assert rows_of(simhash.near_duplicates(no_documents)) == []
