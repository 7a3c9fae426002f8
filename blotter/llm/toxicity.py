"""Toxicity severity by cumulative-link ordinal regression.

``P(grade > k) = sigmoid(w.x - theta_k)``: one weight vector for all grades and
ordered thresholds. ``x`` holds 1 for each distinct word of the text (lower
case, without punctuation at its ends) and 1 for each distinct word's first
``PREFIX`` characters, counted over the distinct words. The expected severity
is the sum of ``P(grade > k)``.

Grades. The labels say toxic or not; severity is what the toxic text shows: a
toxic text has grade 1 and one more for each of ``STEPS`` that the number of
its strongly toxic words reaches (words at least ``LIFT`` times as frequent, in
documents, in the toxic labelled texts as in the others).

Training uses at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other labelled
documents, the first by a hash of the id. Features of fewer than ``MIN_DOCS``
training texts, or that pass no test of independence from the label
(chi-square below ``MIN_CHI2``), have no weight, and L1 drops those the others
make needless. The model is a small dictionary, so scoring a text looks up
its distinct words.

Defined cases: a null or empty text has no features and scores at the base
rate; labels with null parts are ignored, a document labelled twice is toxic
if any label says so; without labelled texts of both kinds nothing is toxic
(severity 0); an empty table gives an empty result; other columns are carried
by :func:`without_toxic`, whatever their names. A labelled id that several rows
have is learnt from one of their texts (the one with the smallest hash).
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import row_text, slices, whole_rows

MAX_TOXIC = 3000
MAX_CLEAN = 5000
MIN_DOCS = 3
PREFIX = 5
LIFT = 8.0
MIN_CHI2 = 10.83  # 1 in 1000 by chance
STEPS = (3, 6)
ROUNDS = 4000
L1 = 3e-4

#: The fit ends when no weight or threshold moves by more than this in a round.
TOLERANCE = 1e-3

#: A document is rejected if it is more likely than not of grade 1 or above.
MIN_PROBABILITY = 0.5

_ENDS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def distinct_words(text: bytes) -> set[bytes]:
    words = {w.strip(_ENDS) for w in set(text.lower().split())}
    words.discard(b"")
    return words


def prefix(word: bytes) -> bytes:
    """The word's first characters, marked as a prefix by a leading space."""
    if len(word) <= PREFIX:
        return b" " + word
    end = PREFIX
    seen = 0
    for end, c in enumerate(word):
        if c & 0xC0 != 0x80:
            seen += 1
            if seen > PREFIX:
                return b" " + word[:end]
    return b" " + word


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    """Weights of words and of prefixes (their own dictionary) and thresholds."""

    words: dict[bytes, float] = field(default_factory=dict)
    prefixes: dict[bytes, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()

    def __post_init__(self):
        #: First bytes of the prefixes: few words go further than these.
        self.heads = {p[1 : 1 + PREFIX] for p in self.prefixes}

    def logit(self, text: bytes) -> float:
        found = distinct_words(text)
        total = sum(map(self.words.__getitem__, found & self.words.keys()))
        for w in found:
            if w[:PREFIX] in self.heads:
                total += self.prefixes.get(prefix(w), 0.0)
        return total

    def above(self, logits: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` by row and threshold."""
        return sigmoid(np.asarray(logits, float)[:, None] - np.array(self.thresholds)[None, :])


def fit_ordinal(
    rows: np.ndarray, cols: np.ndarray, n: int, width: int, grade: np.ndarray, l1: float = L1, rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
):
    """Weights and thresholds of least mean loss plus ``l1`` times the absolute
    weights, for ``n`` texts with 1 at ``(rows, cols)``: accelerated proximal
    gradient steps, thresholds kept in order by their gaps."""
    top = int(grade.max())
    share = np.array([(grade > k).mean() for k in range(top)])
    theta = np.log((1 - share) / share)
    w, step_w = np.zeros(width), np.zeros(width)
    # A step for each feature: the curvature of the loss is at most half the
    # diagonal of summed row sizes, divided by n.
    per_row = np.bincount(rows, minlength=n)
    rate = 2.0 * n / np.maximum(1.0, np.bincount(cols, weights=per_row[rows], minlength=width))
    momentum = 1.0
    for _ in range(rounds):
        s = np.bincount(rows, weights=step_w[cols], minlength=n)
        low, high = np.r_[-np.inf, theta], np.r_[theta, np.inf]
        up, down = sigmoid(high[grade] - s), sigmoid(low[grade] - s)
        likely = np.maximum(up - down, 1e-9)
        d_up, d_down = up * (1 - up), down * (1 - down)
        by_score = (d_up - d_down) / likely / n
        gradient = np.bincount(cols, weights=by_score[rows], minlength=width)
        by_theta = -np.bincount(grade, weights=d_up / likely, minlength=top + 1)[:top] / n
        by_theta += np.bincount(grade, weights=d_down / likely, minlength=top + 1)[1:] / n
        moved = step_w - rate * gradient
        then = np.sign(moved) * np.maximum(np.abs(moved) - rate * l1, 0.0)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        step_w = then + (momentum - 1) / next_momentum * (then - w)
        next_theta = np.maximum.accumulate(theta - by_theta + np.arange(top) * 1e-9)
        moved = max(np.abs(then - w).max(initial=0.0), np.abs(next_theta - theta).max())
        w, momentum, theta = then, next_momentum, next_theta
        if moved < tolerance:
            break
    return w, theta


class Counts:
    """In how many toxic and other training texts each word and prefix is.

    Only these counts are held for all features; the rows of the training
    matrix are made afterwards, for the informative ones alone."""

    def __init__(self, texts: list[bytes], toxic: np.ndarray):
        self.index: dict[bytes, int] = {}
        here, both = array("i"), array("i")
        for text, t in zip(texts, toxic.tolist()):
            words = distinct_words(text)
            for f in words.union(map(prefix, words)):
                i = self.index.setdefault(f, len(here))
                if i == len(here):
                    here.append(0), both.append(0)
                here[i] += 1
                both[i] += t
        self.here, self.both = np.array(here, float), np.array(both, float)
        self.n, self.t = len(toxic), int(toxic.sum())

    def informative(self) -> dict[bytes, int]:
        """Features in enough texts whose presence depends on the label, numbered."""
        gap = self.both * (self.n - self.here - self.t + self.both) - (self.here - self.both) * (self.t - self.both)
        chi2 = self.n * gap**2 / np.maximum(1.0, self.here * (self.n - self.here) * self.t * (self.n - self.t))
        keep = (self.here >= MIN_DOCS) & (chi2 >= MIN_CHI2)
        number = np.cumsum(keep) - 1
        return {f: int(number[i]) for f, i in self.index.items() if keep[i]}

    def strong(self) -> set[bytes]:
        """Words much more frequent in toxic texts."""
        lift = (self.both / self.t) / ((self.here - self.both + 0.5) / (self.n - self.t))
        keep = (self.both >= MIN_DOCS) & (lift >= LIFT)
        return {f for f, i in self.index.items() if keep[i] and f[:1] != b" "}


def fit(texts: list[bytes], toxic: np.ndarray) -> Model:
    toxic = np.asarray(toxic, bool)
    if not toxic.any() or toxic.all():
        return Model()
    counts = Counts(texts, toxic)
    number, strong = counts.informative(), counts.strong()
    del counts
    grade = np.zeros(len(texts), np.int64)
    rows, cols = array("i"), array("i")
    for i, text in enumerate(texts):
        words = distinct_words(text)
        if toxic[i]:
            grade[i] = 1 + sum(len(words & strong) >= s for s in STEPS)
        for w in words:
            for f in (w, prefix(w)):
                if f in number:
                    rows.append(i), cols.append(number[f])
    grade = np.searchsorted(np.unique(grade), grade)  # grades without a text are closed up
    w, theta = fit_ordinal(np.array(rows), np.array(cols), len(texts), len(number), grade)
    weight = {f: float(w[j]) for f, j in number.items() if w[j]}
    return Model(
        {f: v for f, v in weight.items() if f[:1] != b" "}, {f: v for f, v in weight.items() if f[:1] == b" "},
        tuple(float(t) for t in theta),
    )


def training_sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """``text, toxic`` of the first labelled documents by hash: a bounded
    sample, so its ids may be broadcast."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [
        known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for t, n in ((1, max_toxic), (0, max_clean))
    ]
    ids = chosen[0].union(chosen[1])
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    # One text of each id, however many rows repeat it.
    one = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    texts, toxic = [], []
    for row in training_sample(docs, labels, max_toxic, max_clean).toLocalIterator():
        texts.append(row["text"].encode()), toxic.append(row["toxic"] == 1)
    return fit(texts, np.array(toxic, bool)) if texts else Model()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the columns of ``docs``), ``severity`` and ``probability`` (of
    grade 1 or more)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = whole_rows(docs.withColumn("text", F.col("text").cast("string")))

    def run(batches):
        m = shared.value
        for b in slices(batches):
            above = m.above(np.array([m.logit(t) for t in row_text(b)], float)) if m.thresholds else np.zeros((b.num_rows, 1))
            more = [pa.array(above.sum(axis=1)), pa.array(above[:, 0])]
            yield pa.RecordBatch.from_arrays([b.column("row"), *more], ["row", "severity", "probability"])

    return rows.mapInArrow(run, T.StructType([*rows.schema]).add("severity", "double").add("probability", "double"))


def severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, expected_severity, probability, grade, rejected`` of each row."""
    found = scored(docs.select("doc_id", "text"), train(docs, labels))
    return found.select(
        "row.doc_id", F.col("severity").alias("expected_severity"), "probability",
        F.round("severity").cast("int").alias("grade"),
        (F.col("probability") >= MIN_PROBABILITY).alias("rejected"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, same columns."""
    return scored(docs, train(docs, labels)).where(F.col("probability") < MIN_PROBABILITY).select("row.*")
