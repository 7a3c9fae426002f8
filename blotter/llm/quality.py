"""Quality rules: counted rules and a calibrated n-gram classifier.

Rules count words, characters of words, symbols, repeated lines and words in
repeated windows; a text fails them if it is short or mostly repeats itself.
The classifier is a logistic regression on hashed n-grams: words and word
pairs, and byte trigrams of the text, each as a share of its family, so that
long and short texts compare. It is trained on labelled rows (``quality`` 1 is
good), its scores are turned into probabilities on labelled rows held out from
training (Platt scaling), and a text is kept if it passes the rules and its
probability reaches a fixed threshold.

Training uses at most ``MAX_EACH`` labelled documents of each quality, and
calibration at most ``MAX_HELD`` others in their natural proportion, all the
first by a hash of the id.

Defined cases: a null text has no words and fails the rules; labels with null
parts are ignored, a document labelled twice is good only if all labels say
so; without labelled texts of both kinds the rules decide alone (probability
1); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import slices, text_bytes

MAX_EACH = 1500
MAX_HELD = 1500
WORD_BITS = 18
CHAR_BITS = 16
ROUNDS = 200
L2 = 1e-6

#: Fixed limits of the rules.
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

#: The least probability of good quality that is kept.
THRESHOLD = 0.5

_SPACE = b" \t\n\x0b\x0c\r"
_NOT_FIRST = bytes(range(0x80, 0xC0))  # later bytes of a character


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def repeat_words(words: list[bytes], hashes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice.
    Equal hashes are only a hint: such windows are compared word by word."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h, width = hashes, 1
    while 2 * width <= window:
        h = h[: len(h) - width] * np.uint64(0x9E3779B97F4A7C15) + (h[width:] ^ (h[width:] >> np.uint64(29)))
        width *= 2
    for extra in range(width, window):
        h = h[: len(hashes) - extra] * np.uint64(0x9E3779B97F4A7C15) + hashes[extra:]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    number: dict[bytes, int] = {}
    of = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
    # Neighbours of equal hash are compared word by word, all at once.
    one, two = order[:-1][same], order[1:][same]
    equal = np.ones(len(one), bool)
    for k in range(window):
        equal &= of[one + k] == of[two + k]
    found = np.zeros(n, bool)
    found[one[equal]] = found[two[equal]] = True
    if not equal.all():
        # Unlike windows of one hash: those of that hash are told apart by their words.
        for x in np.unique(h[one[~equal]]):
            alike: dict[bytes, list[int]] = {}
            for i in np.flatnonzero(h == x).tolist():
                alike.setdefault(of[i : i + window].tobytes(), []).append(i)
            for places in alike.values():
                found[places] = len(places) > 1
    ends = np.zeros(len(words) + 1, np.int64)
    ends[:n] += found
    ends[window : window + n] -= found
    return int((np.cumsum(ends) > 0).sum())


def counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _SPACE + _NOT_FIRST)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words, hashes),
    )


def features(text: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words and word pairs, and of the byte trigrams."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - WORD_BITS)
    pairs = hashes[:-1] * np.uint64(31) + hashes[1:] + np.uint64(7)
    word = ((np.concatenate([hashes, pairs]) * mix) >> shift).astype(np.int64)
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    three = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) if len(b) > 2 else b[:0]
    char = (three * np.uint32(2654435761)) >> np.uint32(32 - CHAR_BITS)
    return word, char.astype(np.int64)


@dataclass
class Model:
    """Weights of the two families, and ``slope`` and ``shift`` of the
    calibrated logit; no weights: every probability is 1."""

    word: np.ndarray | None = None
    char: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def score(self, text: bytes, hashes: np.ndarray) -> float:
        word, char = features(text, hashes)
        return self.bias + sum(
            float(w[f].mean()) if len(f) else 0.0 for w, f in ((self.word, word), (self.char, char))
        )

    def probability(self, score):
        return sigmoid(self.slope * np.asarray(score, float) + self.shift)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(rows, cols, values, n, width, y, rounds=ROUNDS, l2=L2):
    """Weights and bias of least mean log loss, by accelerated gradient steps
    with a step for each feature: a quarter of the summed products of values
    and row sums bounds its curvature."""
    per_row = np.bincount(rows, weights=values, minlength=n) + 1
    bound = np.bincount(cols, weights=values * per_row[rows], minlength=width) / (4 * n)
    rate = 1.0 / (bound + 1e-7 + l2)
    bias_rate = 1.0 / ((per_row / (4 * n)).sum() + l2)
    w, ahead, b, b_ahead, momentum = np.zeros(width), np.zeros(width), 0.0, 0.0, 1.0
    for _ in range(rounds):
        z = np.bincount(rows, weights=values * ahead[cols], minlength=n) + b_ahead
        error = (sigmoid(z) - y) / n
        w_next = ahead - rate * (np.bincount(cols, weights=values * error[rows], minlength=width) + l2 * ahead)
        b_next = b_ahead - bias_rate * error.sum()
        momentum_next = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / momentum_next
        ahead, b_ahead = w_next + pull * (w_next - w), b_next + pull * (b_next - b)
        w, b, momentum = w_next, b_next, momentum_next
    return w, b


def calibrate(score: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift that fit ``good`` to the scores (Platt, with his
    smoothed targets), by damped Newton steps."""
    up, down = good.sum(), (~good).sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([score, np.ones_like(score)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(x @ theta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0]))
        theta = theta - step / max(1.0, float(np.abs(step).max()))
    return float(theta[0]), float(theta[1])


def fit(train: list[tuple[bytes, bool]], held: list[tuple[bytes, bool]]) -> Model:
    y = np.array([g for _, g in train], bool)
    if not len(y) or y.all() or not y.any():
        return Model()
    rows, cols, values = [], [], []
    width = 1 << WORD_BITS
    for i, (text, _) in enumerate(train):
        for family, base in zip(features(text, word_hashes(text.split())), (0, width)):
            slot, count = np.unique(family, return_counts=True)
            rows.append(np.full(len(slot), i, np.int32))
            cols.append((slot + base).astype(np.int32))
            values.append((count / max(1, len(family))).astype(np.float32))
    used, col = np.unique(np.concatenate(cols), return_inverse=True)
    w, b = fit_logistic(np.concatenate(rows), col.astype(np.int32), np.concatenate(values), len(train), len(used), y)
    weight = np.zeros(width + (1 << CHAR_BITS), np.float32)
    weight[used] = w
    model = Model(weight[:width], weight[width:], float(b))
    good = np.array([g for _, g in held], bool)
    if len(good) and good.any() and not good.all():
        scores = np.array([model.score(t, word_hashes(t.split())) for t, _ in held])
        model.slope, model.shift = calibrate(scores, good)
    return model


def train(docs: DataFrame, labels: DataFrame, max_each: int = MAX_EACH, max_held: int = MAX_HELD) -> Model:
    """The model of a bounded sample of labelled rows, see the module's text."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.min("quality").alias("_quality")
    )
    key = F.xxhash64("_id")
    held = known.where(F.pmod(key, F.lit(5)) == 0).orderBy(key, "_id").limit(max_held)
    rest = known.where(F.pmod(key, F.lit(5)) != 0)
    chosen = held.withColumn("_held", F.lit(True))
    for q in (0, 1):
        chosen = chosen.union(rest.where(F.col("_quality") == q).orderBy(key, "_id").limit(max_each).withColumn("_held", F.lit(False)))
    # At most two times max_each rows and max_held: small enough to broadcast.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    # One text of each id, however many rows repeat it.
    one = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("_id", "_quality", "_held").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")
    )
    learn, check = [], []
    for r in one.toLocalIterator():
        (check if r["_held"] else learn).append((r["text"].encode(), r["_quality"] == 1))
    return fit(learn, check)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the counts, ``base_failed, kept, probability``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        model = shared.value
        for b in slices(batches):
            found, score = [], []
            for text in text_bytes(b):
                words = text.split()
                hashes = word_hashes(words)
                found.append(counts(text, words, hashes))
                score.append(0.0 if model.word is None else model.score(text, hashes))
            good = np.ones(len(score)) if model.word is None else model.probability(score)
            failed = [n < MIN_WORDS or 100 * r > MAX_REPEAT_PERCENT * n for n, _, _, _, r in found]
            kept = [not f and bool(g >= threshold) for f, g in zip(failed, good)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*found)), pa.array(failed), pa.array(kept), pa.array(good)],
                ["doc_id", *COLUMNS, "base_failed", "kept", "probability"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    longs = ", ".join(f"{c} bigint" for c in COLUMNS)
    return rows.mapInArrow(run, f"doc_id bigint, {longs}, base_failed boolean, kept boolean, probability double")
