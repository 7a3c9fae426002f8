"""Benchmark decontamination with a generalised suffix automaton.

Test items are normalised (A-Z lower-cased, words of digits, letters and
characters beyond ASCII) and read into one automaton over word numbers. Each
document is streamed through it word by word: the state and the length of the
longest suffix that occurs in some item. A suffix of ``window`` words or more
is a run of windows of an item, so its words are hit; a shorter item counts as
a whole, through the states that end it.

Spark forms blocks of the items, at most ``BLOCK_WORDS`` words each (a longer item
is cut into pieces that overlap by ``window - 1`` words, which keeps all its
windows), so an automaton has a bounded size however many items there are. The
driver holds one block at a time, to broadcast it. One block, the usual case, is
one pass over the documents. More blocks are a pass each over the texts alone,
which returns the hit texts' digests, spans and items; what the blocks find for
a text is put together and joined to its rows, so no text is written again.
A benchmark of a million words is 10 to 20 blocks and passes.

Defined cases: null texts have no words; items without words are ignored;
items that repeat an id are one item in the counts; an empty benchmark leaves
every document clean; an empty table gives an empty result; other columns are
ignored by :func:`hits` and carried by :func:`cleaned`, whatever their names.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import row_text, saved, slices, text_bytes, whole_rows

WINDOW = 10
BLOCK_WORDS = 100_000

#: A document more than this share of whose words is hit goes as a whole.
MAX_COVERAGE = 0.5

#: One pass that lower-cases A-Z and turns every byte that is no part of a
#: word into a space.
_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


#: The same words as a pattern.
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """Suffix automaton of several word sequences, and which items hold the
    windows that its states stand for."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[list[tuple[str, int]]] = [[]]
        for item, words in items:
            last = 0
            for n, w in enumerate(words, 1):
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
                while len(ends) < len(self.len):
                    ends.append([])
                if n >= window:
                    ends[last].append((item, window))
            if 0 < len(words) < window:
                ends[last].append((item, len(words)))
        self._gather(ends)
        self.shortest = min([window, *(len(w) for _, w in items if w)])

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.len.append(length), self.link.append(link), self.next.append(edges)
        return len(self.len) - 1

    def _extend(self, last: int, c: int) -> int:
        """The state of the sequence read so far and then ``c``."""
        if c in self.next[last]:
            q = self.next[last][c]
            if self.len[q] == self.len[last] + 1:
                return q
            return self._split(last, q, c)
        now = self._state(self.len[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = now
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[now] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, c)
        return now

    def _split(self, p: int, q: int, c: int) -> int:
        """A state for the shorter strings of ``q`` that end with ``p`` and ``c``."""
        half = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = half
            p = self.link[p]
        self.link[q] = half
        return half

    def _gather(self, ends: list[list[tuple[str, int]]]) -> None:
        """``full[s]``: items with the window that ends here, for states whose
        strings are windows or longer. ``short[s]``: ``(length, item)`` of
        whole short items among the suffixes, longest first."""
        n = len(self.len)
        ends += [[] for _ in range(n - len(ends))]
        order = sorted(range(1, n), key=self.len.__getitem__)
        windows: list[set[str]] = [set() for _ in range(n)]
        whole: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        for s in reversed(order):
            for item, length in ends[s]:
                if length == self.window:
                    windows[s].add(item)
            if self.link[s] > 0 and self.len[self.link[s]] >= self.window:
                windows[self.link[s]] |= windows[s]
        for s in range(n):
            whole[s] = sorted({(length, item) for item, length in ends[s] if length < self.window}, reverse=True)
        self.full: list[frozenset[str]] = [frozenset()] * n
        self.short: list[tuple[tuple[int, str], ...]] = [()] * n
        for s in order:
            parent = self.link[s]
            self.short[s] = tuple(whole[s]) + self.short[parent]
            if self.len[s] >= self.window:
                self.full[s] = self.full[parent] if self.len[parent] >= self.window else frozenset(windows[s])

    def scan(self, ids: list[int], at: int, found: set[str], spans: list[tuple[int, int]]) -> None:
        """Stream one run of known words that starts at word ``at``."""
        step, link, length, window = self.next, self.link, self.len, self.window
        state = depth = 0
        for pos, c in enumerate(ids, at):
            while state and c not in step[state]:
                state = link[state]
                depth = length[state]
            to = step[state].get(c)
            if to is None:
                continue
            state, depth = to, depth + 1
            if depth >= window:
                found |= self.full[state]
                spans.append((pos - depth + 1, pos + 1))
            for size, item in self.short[state]:
                if size <= depth:
                    found.add(item)
                    spans.append((pos - size + 1, pos + 1))

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (start, end; words) that are hit, apart and in order, and the
        items whose windows occur. Words of no item end every match, so only
        runs of known words are streamed."""
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False]))
        starts, stops = edge[::2], edge[1::2]
        long = stops - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for a, b in zip(starts[long].tolist(), stops[long].tolist()):
            self.scan(ids[a:b].tolist(), a, found, spans)
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``block, items``: the items as ``(item_id, words)`` in rows of at most
    ``block_words`` words, as few as the words' number asks for (at most twice)."""
    step = block_words - window + 1

    def cut(batches):
        for b in slices(batches):
            ids, words = [], []
            for item, text in zip(b.column("item_id").to_pylist(), text_bytes(b)):
                found = normal_words(text)
                starts = [0] if len(found) <= block_words else range(0, len(found) - window + 1, step)
                for i in starts:
                    if found[i : i + block_words]:
                        ids.append(item or ""), words.append(found[i : i + block_words])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array([b" ".join(w) for w in words], pa.binary()), pa.array([len(w) for w in words], pa.int64())],
                ["item_id", "words", "n"],
            )

    def joined(batches):
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("words", pa.binary())]))
        number, held, items = TaskContext.get().partitionId() << 33, 0, []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([items], kind)], ["block", "items"])

        for b in batches:
            for r in b.to_pylist():
                if items and held + r["n"] > block_words:
                    yield row()
                    number, held, items = number + 1, 0, []
                items.append({"item_id": r["item_id"], "words": r["words"]})
                held += r["n"]
        if items:
            yield row()

    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    pieces, _ = saved(texts.mapInArrow(cut, "item_id string, words binary, n bigint"), "leak-items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // block_words))
    return saved(
        pieces.coalesce(parts).mapInArrow(joined, "block bigint, items array<struct<item_id:string,words:binary>>"), "leak-blocks"
    )[0]


def _read(found: DataFrame, number: int) -> list[tuple[str, list[bytes]]]:
    """One block's items."""
    row = found.where(F.col("block") == number).first()
    return [(r["item_id"], bytes(r["words"]).split()) for r in row["items"]]


_BUILT: dict[tuple[int, int], Automaton] = {}


def _automaton(block, number: int, window: int) -> Automaton:
    """The block's automaton, built once in each worker process. ``number`` is
    the broadcast's own, so no other query's automaton is taken for it."""
    if (number, window) not in _BUILT:
        _BUILT.clear()
        _BUILT[number, window] = Automaton(block.value, window)
    return _BUILT[number, window]


_FOUND = "words bigint, spans array<struct<a:int,b:int>>, items array<string>"
_SPAN_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _pass(rows: DataFrame, block, number: int, window: int) -> DataFrame:
    """``row`` with its words, and the spans and items found in ``block``."""

    def run(batches):
        automaton = _automaton(block, number, window) if block is not None else None
        for b in slices(batches):
            n, spans, items = [], [], []
            for text in row_text(b):
                words = normal_words(text)
                hit, found = automaton.match(words) if automaton else ([], set())
                n.append(len(words))
                spans.append([{"a": x, "b": y} for x, y in hit])
                items.append(sorted(found))
            more = [pa.array(n, pa.int64()), pa.array(spans, _SPAN_TYPE), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column("row"), *more], ["row", "words", "spans", "items"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *T.StructType.fromDDL(_FOUND)]))


def _hit_texts(texts: DataFrame, block, number: int, window: int) -> DataFrame:
    """``key, spans, items`` of the texts (``key, text``) that ``block`` hits."""

    def run(batches):
        automaton = _automaton(block, number, window)
        for b in slices(batches):
            keys, spans, items = [], [], []
            for key, text in zip(b.column("key").to_pylist(), text_bytes(b)):
                hit, found = automaton.match(normal_words(text))
                if hit:
                    keys.append(key), spans.append([{"a": x, "b": y} for x, y in hit]), items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(spans, _SPAN_TYPE), pa.array(items, pa.list_(pa.string()))], ["key", "spans", "items"]
            )

    found = texts.mapInArrow(run, "key string, spans array<struct<a:int,b:int>>, items array<string>")
    return found.groupBy("key").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))


def _together(found: DataFrame) -> DataFrame:
    """What several blocks found in a text (a row a block at most) as one row."""

    def run(batches):
        for b in slices(batches):
            spans = [
                [{"a": x, "b": y} for x, y in merged([(s["a"], s["b"]) for s in every])] for every in b.column("spans").to_pylist()
            ]
            items = [sorted(set(every)) for every in b.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(spans, _SPAN_TYPE), pa.array(items, pa.list_(pa.string()))], ["key", "spans", "items"]
            )

    each = found.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return each.mapInArrow(run, found.schema)


def matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``row`` (the columns of ``docs``) with ``words`` (how many), ``spans`` (hit
    words, start and end) and ``items`` (ids of the items found)."""
    sc = docs.sparkSession.sparkContext
    rows = whole_rows(docs.withColumn("text", F.col("text").cast("string")))
    formed = blocks(benchmark, window, block_words)
    numbers = sorted(r["block"] for r in formed.select("block").collect())

    def shared(number: int):
        block = sc.broadcast(_read(formed, number))
        return block, block._jbroadcast.id()

    if not numbers:
        return _pass(rows, None, 0, window)
    if len(numbers) == 1:
        return _pass(rows, *shared(numbers[0]), window)
    key = F.md5(F.coalesce(F.col("row.text"), F.lit("")))
    texts = rows.select(key.alias("key"), F.col("row.text").alias("text"))
    hit = reduce(DataFrame.union, [saved(_hit_texts(texts, *shared(n), window), "leak-hits")[0] for n in numbers])
    found, _ = saved(_together(hit), "leak-found")
    words = F.regexp_count(F.coalesce(F.col("row.text"), F.lit("")), F.lit(_WORD)).cast("bigint")
    kinds = T.StructType.fromDDL(_FOUND)
    return rows.withColumn("key", key).join(found, "key", "left").select(
        "row", words.alias("words"), *[F.coalesce(c, F.array().cast(kinds[c].dataType)).alias(c) for c in ("spans", "items")]
    )


def _span_words():
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["b"] - s["a"]).cast("bigint"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``."""
    found = matched(docs.select("doc_id", "text"), benchmark, window, block_words)
    n_hit = _span_words()
    return found.select(
        "row.doc_id", F.col("words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "spans",
    )


_RUN = re.compile(rb"[^ ]+")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words in ``spans`` and what lies between them."""
    places = [m.span() for m in _RUN.finditer(text.translate(_NORMAL))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def cleaned(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the matched spans of ``window`` words or more (whole
    short items too). A document with more than ``max_coverage`` of its words
    in such spans goes. ``n_chars`` follows the text; clean rows stay as they
    are."""
    found = matched(docs, benchmark, window, block_words)
    left = found.where(_span_words() <= F.lit(max_coverage) * F.col("words"))

    def run(batches):
        for b in slices(batches):
            row, spans = b.column("row"), b.column("spans").to_pylist()
            if any(spans):
                columns = {f.name: row.field(i) for i, f in enumerate(row.type)}
                texts = columns["text"].to_pylist()
                sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else []
                for i, s in enumerate(spans):
                    if s:
                        texts[i] = without(texts[i].encode(), [(x["a"], x["b"]) for x in s]).decode()
                        if sizes:
                            sizes[i] = len(texts[i])
                columns["text"] = pa.array(texts, columns["text"].type)
                if sizes:
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
                row = pa.StructArray.from_arrays(list(columns.values()), fields=list(row.type))
            yield pa.RecordBatch.from_arrays([row], ["row"])

    return left.mapInArrow(run, T.StructType([left.schema["row"]])).select("row.*")
