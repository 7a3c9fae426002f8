import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from blotter.llm import spelling
from blotter.llm.common import table

SMALL = "/root/testdata/sf0.001"


def plain_variants(rows):
    """The contract, word by word, with near words by deletion keys."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 3}
    near = defaultdict(set)
    keys = defaultdict(list)
    for w in n:
        keys[w].append((w, None))
        for i in range(len(w)):
            keys[w[:i] + w[i + 1 :]].append((w, i))
    for group in keys.values():
        for a, i in group:
            for b, j in group:
                if a != b and (i == j or i is None or j is None):
                    near[a].add(b)
    form = {}
    for w in n:
        if near[w]:
            b = min(near[w], key=lambda x: (-n[x], x))
            if n[b] >= 2 * n[w]:
                form[w] = b

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def found(df, **args):
    out = spelling.variants(df, **args)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("args", [{}, {"cell_words": 60, "block_words": 25, "fit_words": 500}])
def test_variants_equal_brute_force(spark, args):
    """Also with many small cells, and cells dealt over blocks."""
    docs = table(spark, SMALL, "documents")
    want = plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(docs, **args) == want and any(r[1] for r in want)


def test_odd_rows(spark, odd_documents, no_documents):
    texts = [
        (None, "Wörde wörde WÖRDE wörd× ab÷cd ab÷cd ab÷cd"),
        (1, "aaaaa aaaaa aaaaa aaaab aaaab aaaab aaaaab aaaaab aaaaab"),
        (1, "aaaaa aaaaa aaaaa aaaab aaaab aaaab aaaaab aaaaab aaaaab"),
        (2, " ".join(["x" * 40_000] * 3 + ["x" * 40_001] * 9)),
        (3, None), (4, ""), (5, "abcd " * 9),
    ]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in texts], "doc_id bigint, text string, n int, word int")
    want = plain_variants(texts)
    assert found(docs) == want
    assert ("x" * 40_000, "x" * 40_001, "x" * 40_001, 3, 1, 9) in want
    assert found(odd_documents) == plain_variants([(r["doc_id"], r["text"]) for r in odd_documents.collect()])
    assert found(no_documents) == []


def test_chains_of_forms_end_at_the_last(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    text = " ".join(w for i, w in enumerate(words) for _ in range(3 * 2**i))
    # Ids whose hash damages none of these words.
    doc = next(d for d in range(100) if all(zlib.crc32(f"{d}:{w}".encode()) % 97 for w in words))
    rows = found(spark.createDataFrame([(doc, text)], "doc_id bigint, text string"))
    assert [r[1] for r in rows] == [*words[1:], None] and {r[2] for r in rows} == {words[-1]}


def test_planes_reach_every_near_word():
    """Whatever the planes, the ball of a word covers the home cells of all words one edit away."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefé") for _ in range(8)) for _ in range(400)]
    planes, cells = spelling.fit_planes(spelling.letter_counts([w.encode("latin-1") for w in words]), 5)
    assert cells > 8

    def cells_of(w, up, down):
        return {c for c, at in spelling.reached(planes, spelling.letter_counts([w.encode("latin-1")]), up, down) if len(at)}

    for w in words:
        i, c = rng.randrange(8), rng.choice("abcdefé")
        assert len(cells_of(w, False, False)) == 1
        assert cells_of(w[:i] + c + w[i + 1 :], False, False) <= cells_of(w, True, True)
        assert cells_of(w[:i] + c + w[i:], False, False) <= cells_of(w, True, False)


def test_tree_finds_all_within_reach():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 4, (700, spelling.DIMENSIONS)).astype(np.uint8)
    points[:, 6:] = 0
    points[:100] = points[0]
    queries = points[::7]
    apart = np.abs(np.minimum(points, 2)[None].astype(int) - np.minimum(queries, 2)[:, None]).sum(axis=2)
    for reach in (1, 2):
        got = {(int(q), int(p)) for a, b in spelling.Tree(points, 16).near(queries, reach) for q, p in zip(a, b)}
        assert got == {(int(q), int(p)) for q, p in zip(*np.nonzero(apart <= reach))}
