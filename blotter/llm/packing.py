"""Token-id output: documents packed into rows of a fixed length.

Each text is tokenised whole and closed with an end token. Texts longer than a
row are split into pieces without losing a token. Within a batch the pieces go,
longest first, into the row with the least free space that still fits
(best-fit decreasing); a segment tree over the free space, which counts the
open rows for each amount, finds that row in logarithmic time.

A row holds ``input_ids`` (a padded row of the id matrix, little-endian uint32
or uint16), ``cu_seqlens`` (cumulative segment lengths from 0),
``position_ids`` (uint32 or uint16, from 0 again in each segment), the
``doc_ids`` and ``pieces`` of its segments, and ``n_tokens``. A batch is
``BATCH_TOKENS`` tokens of one input partition, so a task holds a bounded
number of them and nothing is shuffled. The same input splits give the same
rows after a task is repeated.

The tokenizer's vocabulary file is a parameter and is read on the executors
from the installed tokenizer files; texts are ordinary text throughout, also
where they spell a special token.

Defined cases: a null or empty text is the end token alone; a null ``doc_id``
is kept as null; repeated rows are packed each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import slices

ROW_TOKENS = 2048
BATCH_TOKENS = 1 << 21
VOCABULARY = "byte_bpe_50k.tiktoken"

#: The free id of the vocabulary, used as the end token and for padding.
END = 50256

SCHEMA = (
    "pack_id bigint, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
    "doc_ids array<bigint>, pieces array<int>"
)


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY):
    """The public byte-level BPE of a rank file: a name among the installed
    files or a path."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The whole text as ordinary text, as uint32."""
    return encoder(vocabulary).encode_to_numpy(text, disallowed_special=())


class FreeSpace:
    """Segment tree over amounts of free space 0..size: how many open rows
    have each amount, and the least amount of at least ``need`` that has one."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, space: int, n: int) -> None:
        at = space + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        self._add(space, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least space of at least ``need``, taken out."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        space = at - self.leaves
        self._add(space, -1)
        return space, self.rows[space].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers; every piece is in one row and no row is longer
    than ``capacity``."""
    rows: list[list[int]] = []
    free = FreeSpace(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        space, row = free.take(lengths[i]) or (capacity, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(i)
        if space > lengths[i]:
            free.put(space - lengths[i], row)
    return rows


def pack(ids: list[int | None], tokens: list[np.ndarray], capacity: int, end: int) -> Iterator[tuple]:
    """Packed rows of some documents, as the fields of ``SCHEMA`` after the id."""
    kind = np.dtype("<u2" if end < 1 << 16 else "<u4")
    at = np.dtype("<u2" if capacity <= 1 << 16 else "<u4")
    pieces = [
        (doc, k, t[start : start + capacity])
        for doc, t in zip(ids, tokens)
        for k, start in enumerate(range(0, len(t), capacity))
    ]
    for row in best_fit_decreasing([len(p[2]) for p in pieces], capacity):
        parts = [pieces[i] for i in row]
        ends = np.cumsum([0, *(len(p[2]) for p in parts)])
        matrix_row = np.full(capacity, end, kind)
        matrix_row[: ends[-1]] = np.concatenate([p[2] for p in parts])
        places = np.zeros(capacity, at)
        for a, b in zip(ends, ends[1:]):
            places[a:b] = np.arange(b - a)
        yield int(ends[-1]), matrix_row.tobytes(), ends.tolist(), places.tobytes(), [p[0] for p in parts], [p[1] for p in parts]


def packed(
    docs: DataFrame, row_tokens: int = ROW_TOKENS, vocabulary: str = VOCABULARY, end: int = END,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """``docs`` (``doc_id, text``) as packed rows, see ``SCHEMA``."""
    kind = pa.schema([
        ("pack_id", pa.int64()), ("n_tokens", pa.int32()), ("input_ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())),
    ])

    def run(batches):
        done = TaskContext.get().partitionId() << 33
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []

        def rows():
            nonlocal done, ids, tokens
            found = list(pack(ids, tokens, row_tokens, end))
            ids, tokens = [], []
            for i in range(0, len(found), 256):
                part = found[i : i + 256]
                numbers = list(range(done, done + len(part)))
                done += len(part)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([numbers, *zip(*part)], kind)], schema=kind)

        held = 0
        for b in slices(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                found = np.append(token_ids(text or "", vocabulary), np.uint32(end))
                ids.append(doc), tokens.append(found)
                held += len(found)
                if held >= batch_tokens:
                    yield from rows()
                    held = 0
        if ids:
            yield from rows()

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_in.mapInArrow(run, SCHEMA)
