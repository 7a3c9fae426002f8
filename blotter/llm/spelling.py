"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is a point: how often it has each letter (a to z, and the other letters
folded into a few more dimensions). One replaced letter moves a point by at most
two in L1 distance, at most one up and one down; one inserted letter moves it by
one. So the near words of a word lie in a small ball around it, in the trees of
its own length and of the next one.

Trees at two levels. Lengths with many words are divided into cells by median
planes fitted on a bounded sample of the words. Every word is in the one cell
that its letter counts lead to, and visits the other cells that the ball around
it reaches (box-pruned by the planes), so all words are searched whatever the
sample. In a cell a local k-d tree over the words prunes by the bounding boxes
of its nodes; what is left is compared by L1 distance and then letter by letter.
Each pair is found once: equal lengths in the cell with the smaller number,
different lengths in the cell of the longer word. Cells with more than
``BLOCK_WORDS`` words (many words of the same letters, which no plane divides)
are dealt over blocks.

A word's form is its near word with the largest count, if that is at least
``RATIO`` times its own; forms are followed to the last by doubling steps.

Defined cases: a null text has no words; a null ``doc_id`` counts as an empty
one in the hash; repeated rows count each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import dropped, saved, slices, text_bytes, whole_groups

#: Fixed values of the contract.
RUN = re.compile("[a-zÀ-ÿ]+")
DAMAGE = 97
MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2

#: Words that a cell aims at, and most of its own words in a task.
CELL_WORDS = 8192
BLOCK_WORDS = 65_536
#: Guests in a task for each own word.
GUESTS_EACH = 16
#: Words on which the planes of the cells are fitted, in all.
FIT_WORDS = 100_000
#: Points in a leaf of a local tree.
LEAF = 48
#: Pairs compared at a time.
PAIRS = 1 << 17
#: Distinct words counted in a task before they are sent on.
HELD_WORDS = 400_000

DIMENSIONS = 32
#: The dimension of each letter, by its (Latin-1) code point.
_DIMENSION = np.array([(c - 97) if 97 <= c < 123 else 26 + c % (DIMENSIONS - 26) for c in range(256)])


# --- counting -------------------------------------------------------------------


def damaged(doc_id: str, run: str) -> str:
    """The run, without one letter where the hash says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words of all texts; counted in each task first, so a
    word that a third of all places hold is a few rows."""

    def run(batches):
        held: dict[str, int] = {}

        def out():
            names, n = list(held), list(held.values())
            held.clear()
            for at in range(0, len(n), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at : at + (1 << 16)], pa.string()), pa.array(n[at : at + (1 << 16)], pa.int64())], ["word", "n"]
                )

        for b in slices(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), text_bytes(b)):
                doc = "" if doc is None else doc
                start = zlib.crc32(f"{doc}:".encode())
                # Of bytes, lower() changes A to Z only.
                for word, n in Counter(RUN.findall(text.lower().decode())).items():
                    if len(word) < min_letters:
                        continue
                    # A run's damage depends on the document and the run alone.
                    if zlib.crc32(word.encode(), start) % DAMAGE == 0:
                        word = damaged(doc, word)
                        if len(word) < min_letters:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield from out()
        yield from out()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


# --- points and cells -----------------------------------------------------------


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of counts for each (Latin-1) word. Counts stop at 255, which never
    sets two words further apart."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    at = np.repeat(np.arange(len(words)), lengths) * DIMENSIONS + _DIMENSION[letters]
    return np.minimum(255, np.bincount(at, minlength=len(words) * DIMENSIONS)).astype(np.uint8).reshape(-1, DIMENSIONS)


#: A plane tree: ``(dimension, most, low, high)`` with ``low`` for counts up to
#: ``most``, or the number of a cell.
Planes = tuple | int


def fit_planes(points: np.ndarray, depth: int, first: int = 0) -> tuple[Planes, int]:
    """Planes that divide ``points`` in halves as even as counts allow, and the
    next free cell number."""
    best = None
    if depth and len(points) > 1:
        for most in range(int(points.max())):
            share = (points <= most).mean(axis=0)
            d = int(np.argmin(np.abs(share - 0.5)))
            if 0 < share[d] < 1 and (best is None or abs(share[d] - 0.5) < best[0]):
                best = (abs(share[d] - 0.5), d, most)
    if best is None:
        return first, first + 1
    _, d, most = best
    low = points[:, d] <= most
    left, first = fit_planes(points[low], depth - 1, first)
    right, first = fit_planes(points[~low], depth - 1, first)
    return (d, most, left, right), first


def reached(planes: Planes, points: np.ndarray, up: bool, down: bool) -> Iterator[tuple[int, np.ndarray]]:
    """``(cell, places)``: the points whose ball reaches a cell, where one edit
    may add one letter (``up``) and take one (``down``). A plane that lies one
    count away uses the move up for its letter; one further away, or of
    another letter than the move, prunes the box."""
    free = np.full(len(points), -1)
    todo = [(planes, np.arange(len(points)), free, free)]
    while todo:
        node, at, ups, downs = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            yield node, at
            continue
        d, most, low, high = node
        count = points[at, d]
        stays = count <= most
        falls = (count == most + 1) & ((downs == -1) | (downs == d)) if down else False
        rises = (count == most) & ((ups == -1) | (ups == d)) if up else False
        ok = stays | falls
        todo.append((low, at[ok], ups[ok], np.where(stays, downs, d)[ok]))
        ok = ~stays | rises
        todo.append((high, at[ok], np.where(stays, d, ups)[ok], downs[ok]))


def cells(words: DataFrame, cell_words: int = CELL_WORDS, fit_words: int = FIT_WORDS) -> dict[int, tuple[Planes, int]]:
    """``(planes, cells)`` of each length that has more than ``cell_words``
    words; other lengths are one cell."""
    sizes = words.groupBy(F.length("word").alias("len")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_words)
    large = {r["len"]: r["n"] for r in sizes.collect()}
    if not large:
        return {}
    # About fit_words words, drawn by their hash: the same ones in every run.
    share = min(1.0, fit_words / sum(large.values()))
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    some = words.where(F.length("word").isin(list(large)) & drawn)
    by_length: dict[int, list[bytes]] = {}
    for r in some.select("word").collect():
        by_length.setdefault(len(r["word"]), []).append(r["word"].encode("latin-1"))
    return {
        length: fit_planes(letter_counts(found), math.ceil(math.log2(large[length] / cell_words)))
        for length, found in by_length.items()
    }


# --- search in a cell -----------------------------------------------------------


def signatures(points: np.ndarray) -> np.ndarray:
    """Counts up to two as bits (one or more; two or more) of 64-bit numbers:
    differing bits are the L1 distance of the counts stopped at two, which is
    never above that of the counts."""
    bits = np.concatenate([points >= 1, points >= 2], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


class Tree:
    """A k-d tree over points: nodes divide at the plane of a letter's count that
    halves them best, and know their bounding boxes. A box is the bits that all
    its points have (``least``) and that any has (``most``)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = signatures(points)
        self.order = np.arange(len(points))
        #: Begin, end, least, most, and the second child (-1: a leaf); the first
        #: child is the next node.
        self.nodes: list[tuple[int, int, np.uint64, np.uint64, int]] = []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            part = self.points[self.order[a:b]]
            number = len(self.nodes)
            self.nodes.append((a, b, np.bitwise_and.reduce(part), np.bitwise_or.reduce(part), -1))
            if parent >= 0:
                self.nodes[parent] = (*self.nodes[parent][:4], number)
            if b - a > leaf:
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
                here = bits[:, np.argmin(np.abs(2 * bits.sum(axis=0, dtype=np.int64) - len(part)))].astype(bool)
                if here.any() and not here.all():
                    mine = self.order[a:b]
                    middle = a + int((~here).sum())
                    self.order[a:b] = np.concatenate([mine[~here], mine[here]])
                    todo.append((middle, b, number))
                    todo.append((a, middle, -1))

    def near(self, points: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(query, point)`` places with an L1 distance of at most ``reach``."""
        queries = signatures(points)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            number, at = todo.pop()
            a, b, least, most, second = self.nodes[number]
            q = queries[at]
            # Bits that a point of the box has too few or too many of.
            at = at[np.bitwise_count((least & ~q) | (q & ~most)) <= reach]
            if not len(at):
                continue
            if second >= 0:
                todo.append((second, at))
                todo.append((number + 1, at))
                continue
            mine = self.order[a:b]
            for j in range(0, len(mine), PAIRS):
                these = mine[j : j + PAIRS]
                step = max(1, PAIRS // len(these))
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    apart = np.bitwise_count(queries[some][:, None] ^ self.points[these][None, :])
                    one, two = np.nonzero(apart <= reach)
                    yield some[one], these[two]


def letters(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def one_replaced(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of equal length differ in exactly one letter."""
    return (x != y).sum(axis=1) == 1


def one_inserted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of ``y``, one letter longer, are rows of ``x`` with a letter put
    in: equal from both ends over the whole shorter word."""
    front = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= x.shape[1]


def search(own: list[bytes], guests: list[bytes], among_own: bool) -> Iterator[tuple[bytes, bytes]]:
    """Pairs between the cell's ``own`` words (of one length) and ``guests`` (of
    the same length, or one letter shorter); ``among_own``: and of its own."""
    length = len(own[0])
    tree, mine = Tree(letter_counts(own)), letters(own)
    kinds = [(own, True)] if among_own else []
    by_length: dict[int, list[bytes]] = {}
    for g in guests:
        by_length.setdefault(len(g), []).append(g)
    kinds += [(found, False) for found in by_length.values()]
    # As many pairs at a time as the words' letters allow.
    step = max(1, PAIRS * DIMENSIONS // length)
    for queries, among in kinds:
        equal = len(queries[0]) == length
        theirs = letters(queries)
        for q, p in tree.near(letter_counts(queries), 2 if equal else 1):
            if among:
                q, p = q[q < p], p[q < p]
            for i in range(0, len(q), step):
                one, two = q[i : i + step], p[i : i + step]
                ok = (one_replaced if equal else one_inserted)(theirs[one], mine[two])
                for j, k in zip(one[ok].tolist(), two[ok].tolist()):
                    yield queries[j], own[k]


def visits(words: DataFrame, planes: dict[int, tuple[Planes, int]]) -> DataFrame:
    """``length, cell, own, word, n``: every word in its own cell and in those
    that it visits: equal lengths in cells above its own, and the next length."""

    def run(batches):
        names = ["length", "cell", "own", "word", "n"]
        for b in (x.slice(at, 8192) for x in batches for at in range(0, x.num_rows, 8192)):
            words_, n = b.column("word").to_pylist(), b.column("n").to_pylist()
            by_length: dict[int, list[int]] = {}
            for i, w in enumerate(words_):
                by_length.setdefault(len(w), []).append(i)
            rows = []
            for length, places in by_length.items():
                points = letter_counts([words_[i].encode("latin-1") for i in places])
                at_home = np.zeros(len(places), np.int64)
                for cell, at in reached(planes[length][0] if length in planes else 0, points, False, False):
                    at_home[at] = cell
                rows += [(length, int(c), True, i) for c, i in zip(at_home, places)]
                if length in planes:
                    for cell, at in reached(planes[length][0], points, True, True):
                        rows += [(length, cell, False, places[k]) for k in at[at_home[at] < cell].tolist()]
                for cell, at in reached(planes[length + 1][0] if length + 1 in planes else 0, points, True, False):
                    rows += [(length + 1, cell, False, places[k]) for k in at.tolist()]
            if rows:
                lengths, cell, own, at = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(lengths, pa.int32()), pa.array(cell, pa.int32()), pa.array(own),
                    pa.array([words_[i] for i in at], pa.string()), pa.array([n[i] for i in at], pa.int64()),
                ], names)

    return words.select("word", "n").mapInArrow(run, "length int, cell int, own boolean, word string, n bigint")


def dealt(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Visits with ``task``, a key for each part of a cell, and ``among``, whether
    a part compares its own words with each other.

    Most cells are one part. One with more than ``block_words`` own words or
    ``GUESTS_EACH`` times as many guests has blocks of own words and parts of
    guests: each block meets each part of the guests, and an own word visits the
    blocks above its own."""
    sizes = rows.groupBy("length", "cell").agg(
        F.ceil(F.count_if("own") / block_words).cast("int").alias("blocks"),
        F.ceil(F.count_if(~F.col("own")) / (GUESTS_EACH * block_words)).cast("int").alias("parts"),
    ).where("blocks > 1 or parts > 1")
    sized = rows.join(sizes, ["length", "cell"], "left")
    blocks, parts = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("blocks", "parts"))
    sized = sized.select(
        "length", "cell", "own", "word", "n", blocks.alias("blocks"), parts.alias("parts"),
        F.pmod(F.xxhash64("word"), blocks).cast("int").alias("block"), F.pmod(F.hash("word"), parts).cast("int").alias("part"),
    )

    def at(block, part, own):
        return F.struct(block.cast("int").alias("block"), part.cast("int").alias("part"), F.lit(own).alias("own"))

    every_block, every_part = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("parts") - 1)
    above = F.filter(every_block, lambda b: b > F.col("block"))
    places = F.when(
        F.col("own"),
        F.concat(
            F.transform(every_part, lambda p: at(F.col("block"), p, True)),
            F.transform(above, lambda b: at(b, F.lit(0), False)),
        ),
    ).otherwise(F.transform(every_block, lambda b: at(b, F.col("part"), False)))
    return sized.withColumn("at", F.explode(places)).select(
        "length", "cell", "at.own", (F.col("at.part") == 0).alias("among"), "word", "n",
        F.xxhash64("length", "cell", "at.block", "at.part").alias("task"),
    )


def near_pairs(words: DataFrame, cell_words: int = CELL_WORDS, block_words: int = BLOCK_WORDS, fit_words: int = FIT_WORDS) -> DataFrame:
    """``a, n_a, b, n_b``: each two words (of ``word, n``) exactly one edit apart, once."""
    rows = dealt(visits(words, cells(words, cell_words, fit_words)), block_words)

    def run(batches):
        found: list[tuple] = []

        def out():
            nonlocal found
            a, n_a, b, n_b = zip(*found)
            found = []
            yield pa.RecordBatch.from_arrays([
                pa.array(a, pa.string()), pa.array(n_a, pa.int64()), pa.array(b, pa.string()), pa.array(n_b, pa.int64())
            ], ["a", "n_a", "b", "n_b"])

        for t in whole_groups(batches, "task"):
            key = t.column("task").to_numpy()
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).tolist()
            for start, stop in zip(edge, [*edge[1:], len(key)]):
                part = t.slice(start, stop - start)
                if part.num_rows < 2:
                    continue
                words_ = [w.encode("latin-1") for w in part.column("word").to_pylist()]
                own = part.column("own").to_pylist()
                if not any(own):
                    continue
                n = dict(zip(words_, part.column("n").to_pylist()))
                mine = [w for w, o in zip(words_, own) if o]
                guests = [w for w, o in zip(words_, own) if not o]
                for a, b in search(mine, guests, part.column("among")[0].as_py()):
                    found.append((a.decode("latin-1"), n[a], b.decode("latin-1"), n[b]))
                    if len(found) >= 1 << 15:
                        yield from out()
        if found:
            yield from out()

    # Cells are many and about equal, so the key alone spreads them.
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(
        run, "a string, n_a bigint, b string, n_b bigint"
    )


# --- forms and roots --------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: each step doubles how far
    the forms are followed. Counts double along a chain, so few steps end it."""
    spark = forms.sparkSession
    now, path = saved(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step, step_path = saved(
            now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        moved = step.where("moved").limit(1).count()
        dropped(spark, path)
        now, path = step.drop("moved"), step_path
        if not moved:
            return now


def variants(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO,
    cell_words: int = CELL_WORDS, block_words: int = BLOCK_WORDS, fit_words: int = FIT_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word."""
    words, _ = saved(word_counts(docs, min_letters, min_count), "spelling-words")
    pairs, pairs_path = saved(near_pairs(words, cell_words, block_words, fit_words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    larger = -F.col("best.less") >= ratio * F.col("n")
    formed, _ = saved(
        words.join(best, "word", "left").select(
            "word", F.when(larger, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(larger, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    dropped(docs.sparkSession, pairs_path)
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("bigint").alias("n_near"), "form_n"
    )
