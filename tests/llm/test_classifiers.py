import re

import duckdb
import numpy as np
from conftest_llm import rows_of

from blotter.llm import quality, toxicity
from blotter.llm.common import table
from blotter.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def labelled():
    sql = f"SELECT text, quality, toxic FROM '{SF}/documents.parquet' JOIN '{SF}/labels.parquet' USING (doc_id) ORDER BY hash(doc_id)"
    return [(t.encode(), q, x) for t, q, x in duckdb.sql(sql).fetchall()]


def test_toxicity_on_held_out_labels():
    rows = labelled()
    cut = len(rows) * 2 // 3
    model = toxicity.fit([r[0] for r in rows[:cut]], np.array([r[2] == 1 for r in rows[:cut]]))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) >= 2
    above = model.above(np.array([model.logit(r[0]) for r in rows[cut:]]))
    assert (np.diff(above, axis=1) <= 0).all()
    toxic = np.array([r[2] == 1 for r in rows[cut:]])
    found = above[:, 0] >= 0.5
    assert found[toxic].mean() > 0.75 and found[~toxic].mean() < 0.005


def test_ordinal_gradient_reaches_a_minimum():
    rnd = np.random.default_rng(0)
    x = rnd.random((400, 6)) < 0.4
    s = x @ np.array([2.0, -1.0, 0.5, 0, 0, 3.0])
    grade = (s + rnd.logistic(size=400) > 2).astype(int) + (s + rnd.logistic(size=400) > 4)
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(rows, cols, 400, 6, grade, l1=0.0, rounds=3000)

    def loss(w, theta):
        z = np.r_[-np.inf, theta, np.inf]
        return -np.log(toxicity.sigmoid(z[grade + 1] - x @ w) - toxicity.sigmoid(z[grade] - x @ w)).mean()

    here = loss(w, theta)
    for i in range(6):
        for d in (-0.02, 0.02):
            assert loss(w + d * np.eye(6)[i], theta) > here - 1e-6


def test_quality_on_held_out_labels():
    rows = labelled()
    train, held, rest = rows[:1500], rows[1500:2200], rows[2200:]
    model = quality.fit([(t, q == 1) for t, q, _ in train], [(t, q == 1) for t, q, _ in held])
    p = model.probability([model.score(t, quality.word_hashes(t.split())) for t, _, _ in rest])
    good = np.array([q == 1 for _, q, _ in rest])
    assert (p[good] >= 0.5).mean() > 0.97 and (p[~good] < 0.5).mean() > 0.7
    for a, b in ((0.0, 0.3), (0.7, 1.01)):  # calibrated: the share of good rows lies where the probabilities say
        if (some := (p >= a) & (p < b)).sum() > 30:
            assert abs(good[some].mean() - p[some].mean()) < 0.12


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)
    )


def test_quality_query_against_plain_counts(spark, odd_documents, no_documents):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    rows = rows_of(QUERIES["op1_quality_rules"](spark, "/root/testdata/sf0.001"))
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COLUMNS) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["probability"] >= quality.THRESHOLD)
    labels = spark.createDataFrame([(1, 1, 0), (5, None, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    odd = {r["doc_id"]: r for r in quality.judged(odd_documents, labels).collect()}
    assert odd[5]["n_repeat_words"] == odd[5]["n_words"] == 30000 and odd[2]["base_failed"] and odd[7]["n_dup_lines"] == 2
    assert rows_of(quality.judged(no_documents, labels)) == []
    severity = toxicity.severity(odd_documents, labels).collect()
    assert len(severity) == odd_documents.count() and not any(r["rejected"] for r in severity)
    assert toxicity.without_toxic(odd_documents, labels).columns == odd_documents.columns
    assert rows_of(toxicity.severity(no_documents, labels.limit(0))) == []


def test_hash_hints_are_checked():
    words = [b"w%d" % (i % 3) for i in range(50)]
    assert quality.repeat_words(words, np.zeros(50, np.uint64)) == quality.repeat_words(words, quality.word_hashes(words)) == 50
    words = [b"w%d" % i for i in range(50)]
    assert quality.repeat_words(words, np.zeros(50, np.uint64)) == 0


def plain_repeats(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    return len({i + k for p in places.values() if len(p) > 1 for i in p for k in range(window)})


def test_repeated_words_equal_brute_force(monkeypatch):
    import random
    import tracemalloc

    rnd = random.Random(4)
    for _ in range(200):
        words = [rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, 60))]
        assert quality.repeat_words(words, quality.word_hashes(words)) == plain_repeats(words)
        # Also where all windows have one hash.
        assert quality.repeat_words(words, np.zeros(len(words), np.uint64)) == plain_repeats(words)
    words = [b"word"] * 500_000
    hashes = quality.word_hashes(words)
    tracemalloc.start()
    assert quality.repeat_words(words, hashes) == len(words)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()


def test_toxicity_query_equals_plain_probabilities(spark):
    """Every row of the query from the fitted weights, word by word."""
    import math

    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels)
    ends = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = rows_of(QUERIES["op3_toxicity"](spark, sf))
    assert len(rows) == len(texts) and model.words and model.prefixes
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        words = {w.strip(ends) for w in WORD.findall((texts[r["doc_id"]] or "").translate(lower))} - {""}
        total = sum(model.words.get(w.encode(), 0.0) + model.prefixes.get(b" " + w[:5].encode(), 0.0) for w in words)
        above = [1 / (1 + math.exp(-(total - t))) for t in model.thresholds]
        assert abs(r["probability"] - above[0]) < 1e-9 and abs(r["expected_severity"] - sum(above)) < 1e-9
        assert r["rejected"] == (above[0] >= 0.5) and r["grade"] == round(sum(above))
    assert sum(r["rejected"] for r in rows) > 0.7 * 51


def test_a_labelled_id_of_many_rows_is_one_training_text(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(200)] + [(2, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.training_sample(docs, labels).count() == 2
