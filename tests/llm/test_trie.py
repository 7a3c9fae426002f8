import hashlib
import math
import zlib
from collections import defaultdict

import pytest

from blotter.llm import trie
from blotter.llm.common import table

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(rows):
    """``(conv_id, turn, role, text)`` rows to the trie's nodes, by all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (
            (
                min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)).encode()).hexdigest(),
            )
            for k, m in members.items()
        ),
        key=str,
    )


def found(df):
    out = trie.nodes(df)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_nodes_equal_brute_force(spark):
    df = table(spark, SF, "conversations")
    assert found(df) == plain_nodes([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])


ODD = [
    (None, 0, "user", "of no conversation"),
    (0, None, None, None), (0, 1, "user", "ünï"), (0, 1, "user", "ünï"),
    (1, 5, "user", "x"), (1, -3, "assistant", ""),
    (7, 0, "user", "x" * 200_000), (7, 1, "user", None),
    (107, 0, "user", "no base"), (-150, 0, "user", "below zero"), (-100, 0, "user", "a base"), (-100, 1, "user", "two"),
    *[(c, t, "user", f"same {t}") for c in range(200, 330) for t in range(4)],
    *[(c, 0, "user", "short") for c in range(300, 330)],
]


@pytest.mark.parametrize("cells", [None, 64])
def test_odd_rows(spark, monkeypatch, cells):
    """Nulls, ties, repeats, negative ids, absent and short bases; also with a
    sketch so full that it proves next to nothing."""
    if cells:
        monkeypatch.setattr(trie, "MIN_CELLS", cells), monkeypatch.setattr(trie, "MAX_CELLS", cells)
    df = spark.createDataFrame([(*r, 1, "y") for r in ODD], "conv_id bigint, turn bigint, role string, text string, n int, p1 string")
    # Equal turn numbers are ordered by digest, so the tied turns here are equal.
    assert found(df) == plain_nodes([r for r in ODD])


def test_running_totals_carry_over_partitions(spark):
    """A conversation over many partitions, and partitions with many conversations."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(1)
    rows = [(c, i, rnd.randrange(100), rnd.getrandbits(62)) for c, k in ((5, 400), (6, 1), (7, 3), (9, 200), (-1, 2)) for i in range(k)]
    want, total, mix = set(), defaultdict(int), defaultdict(int)
    for c, i, x, y in rows:
        total[c] += x
        mix[c] ^= y
        want.add((c, i, total[c], mix[c]))
    df = spark.createDataFrame(rows, "c bigint, i int, x bigint, y bigint").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        out = trie.running(df, [F.col("i")], {"sum": ("x", "sum"), "mix": ("y", "xor")})
        assert {tuple(r) for r in out.select("c", "i", "sum", "mix").collect()} == want
        assert trie.running(df.where("false"), [F.col("i")], {"sum": ("x", "sum")}).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_conversation_with_a_third_of_all_turns(spark):
    rows = [(0, t, "user", f"turn {t % 50}") for t in range(300)] + [(c, t, "user", f"turn {t}") for c in range(50, 110) for t in range(10)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    assert found(df) == plain_nodes(rows)


def test_no_rows_no_root(spark):
    assert found(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")) == []


def test_hash_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 10)
    rows = [(c, 0, "user", "all the same") for c in range(1000, 1100)]
    got = found(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert got == plain_nodes(rows)


def test_sketch_never_counts_too_low(spark):
    rows, _ = trie.saved(trie.paths(table(spark, SF, "conversations")), "test-paths")
    for width in (32, 1 << 15):
        seen = trie.screened(rows, trie.sketch(rows.where("depth > 0"), width), width)
        counts = seen.where("depth > 0").groupBy("p1", "p2").count()
        wrong = seen.where("single").join(counts, ["p1", "p2"]).where("count > 1").count()
        assert wrong == 0
    proven = seen.where("single").count()
    single = seen.where("depth > 0").join(counts.where("count = 1"), ["p1", "p2"]).count()
    assert proven >= 0.95 * single > 0
