"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: lower-cased words, ``shingle`` words a shingle, XXH64 of each,
and the majority of every bit. Texts link at ``distance`` or fewer differing
bits; a component is what links reach.

Search. Bits that differ together are put into one partition; partition ``i``
gets a threshold ``t_i`` (-1: not probed) with ``sum(t_i + 1) = distance + 1``,
so two linked fingerprints differ in at most ``t_i`` bits of some partition.
Dynamic programming over the partitions chooses the thresholds with the least
estimated probes and candidates. Each fingerprint is entered under its own
bits of every probed partition and probes the larger values within ``t_i``;
whatever meets is verified on all 64 bits. Equal fingerprints are one entry
from the start, so copies never make pairs.

Within one value, a group returns a spanning forest of its links, not all of
its pairs. Values that hold more than a thousandth of the entries are dealt
over blocks, and every two blocks are compared in a task of their own.

Defined cases: a null or empty text has fingerprint zero and links like any
other; a null ``doc_id`` never names a component with other ids in it; an
empty table gives an empty result; other columns are ignored, and carried by
:func:`first_of_each` whatever their names.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import hot_values, salted_join, saved, slices, text_bytes, whole_groups, whole_rows
from blotter.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42

#: Fingerprints on which partitions and thresholds are fitted. They decide
#: what the search costs, never what it finds.
FIT_ROWS = 2000

#: Blocks into which a hot value is dealt, doubled until a block has no more
#: than ``BLOCK_ROWS`` of its entries; each two blocks are one group.
BLOCKS = 16
BLOCK_ROWS = 100_000

_PART_SHIFT = 48  # a partition's number above its (at most 48) bits


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[len(words) - n :] - 1).tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 15)], stops[at : at + (1 << 15)])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed long)."""

    def run(batches):
        for b in slices(batches):
            fp = [fingerprint(t, shingle) for t in text_bytes(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp, pa.int64())], ["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    ids = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return ids.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


# --- partitions and thresholds ------------------------------------------------


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]


def correlated_groups(bits: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in ``m`` groups of about equal width, each grown from the
    first free bit by the bits most correlated with it."""
    x = bits - bits.mean(axis=0)
    sd = np.sqrt((x * x).mean(axis=0))
    corr = np.abs((x.T @ x) / len(x)) / np.maximum(np.outer(sd, sd), 1e-9)
    free, groups = list(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        group = [free.pop(0)]
        while len(group) < width:
            best = max(free, key=lambda b: corr[b, group].mean())
            free.remove(best)
            group.append(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds (-1 or more) of least total cost with ``sum(t + 1) = budget``;
    ``costs[i][t + 1]`` is the cost of threshold ``t`` on partition ``i``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for k in range(min(budget - used, len(c) - 1) + 1):
                if used + k not in step or total + c[k] < step[used + k][0]:
                    step[used + k] = (total + c[k], [*chosen, k - 1])
        best = step
    return best[budget]


def plan_search(sample: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of each probed partition for ``n`` fingerprints.

    The share of pairs within a threshold is estimated twice, from the pairs
    of the sample and from its bits taken as independent, and the larger
    one counts. A probe is a row to shuffle, a candidate one comparison."""
    bits = _bits(sample).astype(np.float64) if len(sample) else np.zeros((1, 64))
    some = bits[:700]
    found = None
    for m in range(1, distance + 2):
        groups = correlated_groups(bits, m) if len(sample) > 1 else [list(range(i, 64, m)) for i in range(m)]
        if len(groups[0]) > _PART_SHIFT:
            continue
        costs = []
        for g in groups:
            ones = some[:, g]
            apart = ones @ (1 - ones).T + (1 - ones) @ ones.T
            pairs = max(1, len(some) * (len(some) - 1))
            differ = 2 * bits[:, g].mean(axis=0) * (1 - bits[:, g].mean(axis=0))
            spread = np.array([1.0])
            for p in differ:
                spread = np.convolve(spread, [1 - p, p])
            row, probes = [0.0], 0.5
            for t in range(0, distance + 1):
                probes += comb(len(g), t) / 2
                near = max(((apart <= t).sum() - len(some)) / pairs, spread[: t + 1].sum())
                row.append(n * probes + 0.2 * near * n * n / 2 if probes < 2000 else float("inf"))
            costs.append(row)
        cost, chosen = allocate(costs, distance + 1)
        if found is None or cost < found[0]:
            found = (cost, [(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return found[1]


# --- probe and verify -----------------------------------------------------------


def _entries(plan: list[tuple[list[int], int]]):
    """Maps fingerprints to ``key, fp, own``: the own value of each probed
    partition, and the larger values within its threshold."""
    flips = []
    for bits, t in plan:
        masks = [sum(1 << b for b in c) for k in range(1, t + 1) for c in combinations(range(len(bits)), k)]
        flips.append(np.array(masks, np.int64))

    def run(batches):
        for b in (x.slice(at, 4096) for x in batches for at in range(0, x.num_rows, 4096)):
            fps = b.column("fp").to_numpy(zero_copy_only=False)
            for i, (bits, _) in enumerate(plan):
                value = np.zeros(len(fps), np.int64)
                for place, bit in enumerate(bits):
                    value |= ((fps >> bit) & 1) << place
                tag = np.int64(i) << _PART_SHIFT
                near = value[:, None] ^ flips[i][None, :]
                at, which = np.nonzero(near > value[:, None])
                key = np.concatenate([value, near[at, which]]) | tag
                out = [key, np.concatenate([fps, fps[at]]), np.arange(len(key)) < len(fps)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["key", "fp", "own"])

    return run


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(own: np.ndarray, guests: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that the links among ``own`` and between ``own``
    and ``guests`` connect: whatever is found links to its finder and is not
    looked for again."""
    own, guests = np.unique(own), np.unique(guests)
    u, v = [own[:0]], [own[:0]]
    while len(own):
        queue, own = [(own[0], True)], own[1:]
        while queue and (len(own) or len(guests)):
            x, is_own = queue.pop()
            near = _apart(own, x) <= distance
            found, own = own[near], own[~near]
            u.append(np.full(len(found), x)), v.append(found)
            queue.extend((f, True) for f in found)
            if is_own:
                near = _apart(guests, x) <= distance
                found, guests = guests[near], guests[~near]
                u.append(np.full(len(found), x)), v.append(found)
                queue.extend((f, False) for f in found)
    return np.concatenate(u), np.concatenate(v)


def _links(distance: int, small: int = 64):
    """Maps entries sorted by ``key`` and own first to verified links ``u, v``:
    all of them in groups up to ``small`` entries, a forest in larger ones."""

    def run(batches):
        for t in whole_groups(batches, "key"):
            key, fp, own = (t.column(c).to_numpy() for c in ("key", "fp", "own"))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            u, v = [], []
            for at, n in zip(first[size > small], size[size > small]):
                o, f = own[at : at + n], fp[at : at + n]
                for side, part in zip((u, v), forest(f[o], f[~o], distance)):
                    side.append(part)
            end = np.repeat(first + size, size)
            i = np.flatnonzero(own & np.repeat(size <= small, size))
            step = 1
            while len(i := i[i + step < end[i]]):
                near = _apart(fp[i], fp[i + step]) <= distance
                u.append(fp[i[near]]), v.append(fp[i[near] + step])
                step += 1
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return run


def dealt(entries: DataFrame) -> DataFrame:
    """Entries of hot values under a key for each two of the value's blocks,
    whose number follows the counted entries."""
    blocks, larger = F.lit(BLOCKS), {}
    for r in entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect():
        n = BLOCKS
        while n * BLOCK_ROWS < r["n"]:
            n *= 2
        if n > BLOCKS:
            larger.setdefault(n, []).append(r["key"])
    for n, keys in larger.items():
        blocks = F.when(F.col("key").isin(keys), F.lit(n)).otherwise(blocks)
    block = F.pmod(F.xxhash64("fp"), blocks)
    other = F.explode(F.sequence(F.lit(0), blocks - 1).cast("array<bigint>"))
    pair = F.xxhash64("key", F.least("b", "o"), F.greatest("b", "o"))
    return entries.withColumn("b", block).withColumn("o", other).select(pair.alias("key"), "fp", "own")


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``u, v``: links between distinct fingerprints (column ``fp``), enough
    to connect all that all links connect."""
    n = fps.count()
    sample = fps.orderBy(F.xxhash64("fp")).limit(FIT_ROWS).select("fp").toPandas()["fp"].to_numpy()
    plan = plan_search(sample, n, distance)
    own = fps.select("fp").mapInArrow(_entries([(b, 0) for b, _ in plan]), "key bigint, fp bigint, own boolean")
    hot = hot_values(own, "key")
    entries = fps.select("fp").mapInArrow(_entries(plan), "key bigint, fp bigint, own boolean")
    if hot:
        entries = entries.where(~F.col("key").isin(hot)).union(dealt(entries.where(F.col("key").isin(hot))))
    sorted_entries = entries.repartition("key").sortWithinPartitions("key", F.col("own").desc())
    return sorted_entries.mapInArrow(_links(distance), "u bigint, v bigint")


def _rooted(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows, and ``fp, least, root`` of each distinct one:
    its smallest ``doc_id`` and the fingerprint that names its component."""
    prints, _ = saved(fingerprints(docs, shingle), "simhash-fp")
    entries, _ = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(entries, distance))
    rooted = entries.join(roots, entries["fp"] == roots["u"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    return prints, rooted


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row; ``component_id`` is
    the smallest ``doc_id`` that links reach."""
    prints, rooted = _rooted(docs, shingle, distance)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named, _ = saved(
        salted_join(rooted.select("fp", "root"), names, "root", F.col("fp")).select("fp", "component_id"), "simhash-names"
    )
    joined = salted_join(prints, named, "fp", F.monotonically_increasing_id())
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component, same columns: that of its smallest
    ``doc_id`` (nulls last; rows that repeat an id, by a hash of the text)."""
    prints, rooted = _rooted(docs, shingle, distance)
    # One row of each distinct fingerprint first, so a fingerprint that a third
    # of all rows have is a row for each map task.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    each = prints.groupBy("fp").agg(first.alias("first"))
    stays, _ = saved(
        each.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first")).select(
            F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")
        ),
        "simhash-stays",
    )
    keyed = whole_rows(docs).select(
        "row", F.col("row.doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("row.text").cast("string")).alias("text_hash")
    )
    kept = keyed.join(stays, keyed["doc_id"].eqNullSafe(stays["id"]) & (keyed["text_hash"] == stays["hash"]), "left_semi")
    # Only rows that repeat id and text are brought together.
    repeats = prints.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeats.limit(1).count():
        return kept.select("row.*")
    return kept.groupBy("doc_id", "text_hash").agg(F.first("row").alias("row")).select("row.*")
