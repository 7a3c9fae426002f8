"""Substring dedup: relative Lempel-Ziv factors of each document against an
index of every block of documents.

A window is ``window`` consecutive words. A window that also starts earlier
(smaller id, or earlier in the same document) has a source; neighbouring
windows with neighbouring sources are one factor of the document, copied from
the earlier text, and its words are removed. What has no source is literal.

At scale no task can hold the reference, so it is indexed by anchors. Of the
``ANCHOR``-word pieces inside a window the one with the least hash is its
anchor; equal windows have equal anchors, and neighbouring windows mostly share
one, which makes a run. So

1. every block sends the anchors of its runs, once each;
2. anchors with a single place in the corpus are dropped: their windows are
   unique. The others go back to their blocks, with the number of their places;
3. every block sends the runs of such anchors with a hash of each window. Of
   equal runs in a block only the earliest goes; the others have it as source;
4. runs meet by anchor. Each window finds its earliest place, and pieces with
   neighbouring sources go back to the block;
5. the block joins pieces across run ends into factors and removes them.

A hot passage therefore sends one row for each block and variant, whatever
the number of its copies. A phrase in many different surroundings is a hot
anchor: its windows are sent one by one, under keys made of the anchor and some
bits of the window's own hash, the more keys the more places the anchor has. So
equal windows still meet, and no key has more than about ``HOT_PLACES`` distinct
ones. A task reads a key's runs in order and holds its distinct windows only.
The index is complete: every window of every
document probes it, so factor ends lose nothing. Windows that meet at an anchor
are compared by 64 bits of hash of their own: the anchor's 64 bits are the same
for all of them, however many a frequent phrase brings together.

Defined cases: a null text has no words; a null id sorts last; rows with equal
id and start are no source of each other; texts under ``window`` words have no
windows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blotter.llm.common import block_body, hashed, saved, word_blocks

WINDOW = 20
ANCHOR = 10
_LAST = np.iinfo(np.int64).max  # a null id

#: Places of an anchor beyond which its windows are dealt over several keys.
HOT_PLACES = 1 << 15

_M = np.uint64(0x9E3779B97F4A7C15)


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values, by doubling."""

    def meet(a, b):
        n = min(len(a), len(b))
        x = a[:n] * _M + (b[:n] ^ (b[:n] >> np.uint64(29)))
        return x ^ (x >> np.uint64(32))

    out, have = None, 0
    power, size = h, 1
    while width:
        if width & 1:
            out, have = (power, size) if out is None else (meet(out, power[have:]), have + size)
        width >>= 1
        if width:
            power, size = meet(power, power[size:]), 2 * size
    return out


def least(g: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        g, have = np.minimum(g[: len(g) - have], g[have:]), 2 * have
    return np.minimum(g[: len(g) - (width - have)], g[width - have :]) if width > have else g


def _windows(words: list[bytes], lens: np.ndarray, window: int, anchor: int):
    """Hashes of the pieces and of the windows, the anchor of each window, and
    whether it lies inside one document; places are those in the block."""
    h = hashed(words)
    pieces, whole = rolled(h, anchor), rolled(h, window)
    low = least(pieces, window - anchor + 1)
    doc = np.repeat(np.arange(len(lens)), lens)
    return pieces, whole, low, doc[: len(whole)] == doc[window - 1 :], doc[: len(whole)]


def anchor_places(words: list[bytes], lens: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's anchors and how many of its pieces are chosen as each."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pieces, _, low, inside, _ = _windows(words, lens, window, anchor)
    span = window - anchor + 1
    pad = np.zeros(span - 1, np.uint64)
    # A piece is chosen if it is the least of a window it lies in, and so the
    # greatest of the anchors of those windows.
    greatest = ~least(~np.concatenate([pad, np.where(inside, low, np.uint64(0)), pad]), span)
    return np.unique(pieces[(greatest == pieces) & (greatest > 0)], return_counts=True)


def runs(words: list[bytes], lens: np.ndarray, window: int, anchor: int):
    """``anchor, first, count`` of the block's runs (windows by their first
    word) and the hash of every window."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    _, whole, low, inside, doc = _windows(words, lens, window, anchor)
    new = np.r_[True, (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])]
    first = np.flatnonzero(new & inside)
    # A run ends where the next begins or its document has no more windows.
    ends = np.append(np.flatnonzero(new | ~inside), len(low))
    count = ends[np.searchsorted(ends, first, side="right")] - first
    return low[first], first, count, whole


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchors(window: int, anchor: int):
    """Step 1: ``anchor, block, places`` of each block, an anchor once."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                value, places = anchor_places(block_body(row["body"]), np.array(row["lens"], np.int64), window, anchor)
                places = places.astype(np.int32)
                for at in range(0, len(value), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield _batch({
                        "anchor": _signed(value[part]), "block": np.full(len(value[part]), row["block"], np.int64),
                        "places": places[part],
                    })

    return run


def repeated_anchors(anchors: DataFrame) -> DataFrame:
    """Step 2: ``block, anchor, total`` of anchors with two places or more. An
    anchor's rows, one a block, are summed by a window that spills."""
    total = F.sum("places").over(W.partitionBy("anchor"))
    return anchors.withColumn("total", total).where("total > 1").select("block", "anchor", "total")


_RUN_SCHEMA = (
    "anchor bigint, block bigint, doc int, start int, doc_id bigint, marks binary, count int, source bigint, source_start int"
)


def _shared_runs(window: int, anchor: int):
    """Step 3: the block's runs of repeated anchors. ``marks`` (8 bytes a
    window) are null in runs whose source is already known."""

    def run(key, block: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        anchors, totals = known.column("anchor").to_numpy(), known.column("total").to_numpy()
        for row in block.to_pylist():
            lens, doc_ids = np.array(row["lens"], np.int64), row["doc_ids"]
            low, first, count, whole = runs(block_body(row["body"]), lens, window, anchor)
            order = np.argsort(anchors)
            at = np.minimum(np.searchsorted(anchors[order], _signed(low)), max(len(anchors) - 1, 0))
            here = anchors[order][at] == _signed(low) if len(anchors) else np.zeros(len(low), bool)
            low, first, count = _signed(low[here]), first[here], count[here]
            keys = 1 + (totals[order][at[here]] // HOT_PLACES if len(anchors) else np.zeros(0, np.int64))
            offset = np.concatenate([[0], np.cumsum(lens)])
            doc = np.searchsorted(offset, first, side="right") - 1
            start = first - offset[doc]
            ids = np.array([_LAST if d is None else d for d in doc_ids], np.int64)[doc] if len(doc) else first
            marks = [whole[a : a + n].tobytes() for a, n in zip(first.tolist(), count.tolist())]
            seen: dict[tuple[int, bytes], tuple[int, int]] = {}
            source, source_start = np.full(len(low), -1, np.int64), np.full(len(low), -1, np.int32)
            known_at = np.zeros(len(low), bool)
            for i in np.lexsort((start, ids)).tolist():
                place = (int(ids[i]), int(start[i]))
                before = seen.setdefault((int(low[i]), marks[i]), place)
                if before < place:
                    known_at[i], source[i], source_start[i] = True, *before
            # A run with a known source only passes through step 4: any key will do.
            spread = np.arange(len(low), dtype=np.uint64) * _M + np.uint64(row["block"] % (1 << 32))
            key = np.where(known_at, _signed(spread), low)
            # The windows of hot anchors go one by one, dealt by their hashes.
            hot = np.flatnonzero((keys > 1) & ~known_at)
            run = np.repeat(hot, count[hot])
            step = np.arange(len(run)) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
            mark = whole[first[run] + step]
            part = mark % keys[run].astype(np.uint64)
            dealt = _signed((low[run].view(np.uint64) ^ part * np.uint64(0xD6E8FEB86659FD93)) * _M)
            cold = np.ones(len(low), bool)
            cold[hot] = False
            at = np.concatenate([np.flatnonzero(cold), run])
            every = [None if k else m for k, m in zip(known_at.tolist(), marks)]
            one = np.concatenate([np.zeros(int(cold.sum()), np.int64), step])
            out.append(pa.table({
                "anchor": np.concatenate([key[cold], dealt]), "block": np.full(len(at), row["block"], np.int64),
                "doc": doc[at].astype(np.int32), "start": (start[at] + one).astype(np.int32), "doc_id": ids[at],
                "marks": pa.array([every[i] for i in np.flatnonzero(cold).tolist()] + [m.tobytes() for m in mark], pa.binary()),
                "count": np.concatenate([count[cold], np.ones(len(run), np.int64)]).astype(np.int32),
                "source": source[at], "source_start": source_start[at],
            }))
        return pa.concat_tables(out) if out else _EMPTY_RUNS

    return run


_EMPTY_RUNS = pa.table({
    "anchor": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "doc": pa.array([], pa.int32()),
    "start": pa.array([], pa.int32()), "doc_id": pa.array([], pa.int64()), "marks": pa.array([], pa.binary()),
    "count": pa.array([], pa.int32()), "source": pa.array([], pa.int64()), "source_start": pa.array([], pa.int32()),
})

_PIECES = ("block", "doc", "start", "count", "source", "source_start")


def _sources(batches):
    """Step 4: pieces of windows with neighbouring sources. Runs come sorted
    by anchor, id and start, so the first of equal windows is the earliest. Of
    a key that a batch does not end, the distinct windows and their places are
    taken on to the next batch."""
    held_key, held = None, None  # an open key; its windows' hashes, ids and starts
    for t in (b for b in batches if b.num_rows):
        given = {c: t.column(c).to_numpy(zero_copy_only=False) for c in _PIECES}
        known = given["source_start"] >= 0  # its key is no anchor
        if known.any():
            yield _batch({c: v[known] for c, v in given.items()})
        if known.all():
            continue
        t = t.filter(pa.array(~known))
        anchor, block, doc, start, ids, count = (
            t.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "block", "doc", "start", "doc_id", "count")
        )
        mark = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint64)
        before = 0
        if held is not None and anchor[0] == held_key:
            # Windows of earlier batches stand in front, as runs of one that are no one's.
            before = len(held[0])
            mark = np.concatenate([held[0], mark])
            ids, start = np.concatenate([held[1], ids]), np.concatenate([held[2], start])
            block, doc, count = (np.concatenate([np.full(before, v, c.dtype), c]) for v, c in ((-1, block), (-1, doc), (1, count)))
            anchor = np.concatenate([np.full(before, held_key, anchor.dtype), anchor])
        group = np.cumsum(np.r_[False, anchor[1:] != anchor[:-1]])
        row = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        place = start[row].astype(np.int64) + step
        order = np.lexsort((mark, group[row]))
        by_group, by_mark = group[row][order], mark[order]
        head = np.flatnonzero(np.r_[True, (by_group[1:] != by_group[:-1]) | (by_mark[1:] != by_mark[:-1])])
        earliest = np.empty(len(row), np.int64)
        earliest[order] = np.repeat(order[head], np.diff(np.r_[head, len(row)]))
        source, source_start = ids[row][earliest], place[earliest]
        last = order[head][by_group[head] == group[-1]]
        held_key, held = anchor[-1], (mark[last].copy(), ids[row][last], place[last].astype(np.int32))
        later = (source < ids[row]) | ((source == ids[row]) & (source_start < place))
        later &= row >= before
        joins = np.r_[False, later[:-1] & (row[1:] == row[:-1]) & (source[1:] == source[:-1]) & (np.diff(source_start) == 1)]
        begin = np.flatnonzero(later & ~joins)
        if len(begin):
            size = np.add.reduceat(later.astype(np.int64) * 1, begin)
            # reduceat runs to the next beginning; windows between that are not
            # later add nothing.
            r = row[begin]
            yield _batch({
                "block": block[r], "doc": doc[r], "start": place[begin].astype(np.int32), "count": size.astype(np.int32),
                "source": source[begin], "source_start": source_start[begin].astype(np.int32),
            })


_RESULT = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, "
    "factors array<struct<start:int,words:int,source:bigint,source_start:int>>"
)
_FACTOR = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))


def factors(pieces: list[tuple[int, int, int, int]], window: int) -> list[dict]:
    """Pieces ``(start, windows, source, source start)`` of a document joined
    across run ends where their sources are neighbours too."""
    out: list[list[int]] = []
    for start, count, source, at in sorted(pieces):
        last = out[-1] if out else None
        if last and start == last[0] + last[1] and source == last[2] and at == last[3] + last[1]:
            last[1] += count
        else:
            out.append([start, count, source, at])
    return [
        {"start": s, "words": n + window - 1, "source": None if d == _LAST else d, "source_start": a} for s, n, d, a in out
    ]


def _removed(window: int, with_text: bool):
    """Step 5: the block's documents without their factors."""

    def run(key, block: pa.Table, found: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], [], [], []]
        where = found.column("doc").to_numpy()
        order = np.argsort(where, kind="stable")
        rows = list(zip(*(found.column(c).to_numpy()[order].tolist() for c in ("start", "count", "source", "source_start"))))
        edge = np.searchsorted(where[order], np.arange(0, 1 + max((len(r["lens"]) for r in block.to_pylist()), default=0)))
        for row in block.to_pylist():
            words, at = block_body(row["body"]), 0
            for i, (doc_id, n) in enumerate(zip(row["doc_ids"], row["lens"])):
                mine = words[at : at + n]
                at += n
                parse = factors(rows[edge[i] : edge[i + 1]], window)
                if parse:
                    mark = np.zeros(n + 1, np.int64)
                    for f in parse:
                        mark[f["start"]] += 1
                        mark[f["start"] + f["words"]] -= 1
                    gone = np.cumsum(mark)[:n] > 0
                    mine = [w for w, g in zip(mine, gone.tolist()) if not g]
                text = b" ".join(mine)
                values = (doc_id, n, n - len(mine), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None, parse)
                for c, v in zip(columns, values):
                    c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), _FACTOR]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "factors"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def deduplicated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept, factors`` of each row;
    ``kept`` is null unless ``with_text``."""
    blocks, _ = saved(word_blocks(docs), "rlz-blocks")
    anchors = blocks.select("block", "lens", "body").mapInArrow(
        _anchors(window, anchor), "anchor bigint, block bigint, places int"
    )
    repeated = repeated_anchors(anchors)
    by_block = blocks.groupBy("block")
    shared = by_block.cogroup(repeated.groupBy("block")).applyInArrow(_shared_runs(window, anchor), _RUN_SCHEMA)
    pieces = (
        shared.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start")
        .mapInArrow(_sources, "block bigint, doc int, start int, count int, source bigint, source_start int")
    )
    return by_block.cogroup(pieces.groupBy("block")).applyInArrow(_removed(window, with_text), _RESULT)
