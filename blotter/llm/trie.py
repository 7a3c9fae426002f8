"""Prefix trie of conversations, with count-min screening of prefix digests.

Every conversation is rebuilt: its first ``h`` turns come from its base
conversation (``crc32(id) % HEADS`` turns of ``id - id % GROUP``), its own turns
after its first ``h`` follow. A node is a distinct sequence of first turns; its
members are the conversations that start with it.

A turn is known by 120 bits of a digest of its role and text and by the text's
length, so no text is shuffled. A prefix is the exclusive or of its turns'
digests, each mixed with its place: 128 bits, by a running aggregate.

Screening. A count-min sketch counts the conversations of each prefix, never
too low. An estimate of one proves that the node has one member, so its
row is written where the conversation lies. Only prefixes that may be shared
are shuffled and grouped exactly, with partial aggregation, so a prefix that a
third of all conversations begin with is a row for each map task. The sketch
has a bounded size (``MAX_CELLS`` cells of two bits); a fuller one proves less,
which costs shuffled rows and changes no result.

Sums over subtrees go up the path of one conversation: the smallest member of a
node is so for every deeper node on its path, so each node's share is added
once, at all places of that conversation's path that may be shared.

The hash over the ids that end at a node is a chain. The ids are sorted over
range partitions, joined to strings of at most ``CHUNK_IDS`` ids there, and
these are streamed through the hash in order.

Whatever runs along a conversation (numbers of turns, digests of prefixes, sums
from its end) is a running total: rows are sorted over range partitions, each task
adds up what it has, and the totals of conversations that reach over a partition's
end, at most one for each partition, are carried on. So a conversation with a
third of all turns is many tasks' work.

Defined cases: a null ``conv_id`` belongs to no conversation; a null role or
text is empty; turns with the same number are ordered by their digests;
repeated rows are turns of their own; an empty table gives an empty result (no
root); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import saved

#: Fixed values of the contract: ids that share a base, and turns taken from it.
GROUP = 100
HEADS = 6

#: Rows of the sketch, and its bounds in cells (two bits each): 32 MB at most.
ROWS = 2
MIN_CELLS = 1 << 16
MAX_CELLS = 1 << 27
#: Cells for each prefix, while the bound allows.
CELLS_EACH = 8
#: The sketch is summed in segments of this many cells.
SEGMENT = 1 << 20

CHUNK_IDS = 8192

_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digests(conversations: DataFrame) -> DataFrame:
    """``c, turn, d1, d2, n``: digest and length of each turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))

    def lane(at: int):
        # 60 bits of the digest's 64, which fit a signed long.
        return F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")

    return conversations.select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn"),
        lane(1).alias("d1"), lane(17).alias("d2"), F.length(text).cast("bigint").alias("n"),
    ).where("c is not null")


def running(rows: DataFrame, order: list[Column], totals: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with running totals along each conversation ``c`` in ``order``:
    ``{name: (long column, "sum" or "xor")}``, each row's own value included.

    Nothing but a row for each partition meets in one place."""
    ufuncs = {"sum": np.add, "xor": np.bitwise_xor}
    names = list(totals)

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, done, open_c, held = TaskContext.get().partitionId(), 0, None, {}
        for b in batches:
            if not b.num_rows:
                continue
            c = b.column("c").to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            size = np.diff(np.r_[first, len(c)])
            out = []
            for name, (column, how) in totals.items():
                step = ufuncs[how]
                total = step.accumulate(b.column(column).to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.concatenate([[0], total])[first]
                total = total - np.repeat(before, size) if how == "sum" else total ^ np.repeat(before, size)
                if c[0] == open_c:
                    total[: size[0]] = step(total[: size[0]], held[name])
                held[name] = total[-1]
                out.append(pa.array(total))
            open_c = c[-1]
            place = np.arange(done, done + len(c))
            done += len(c)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *out, pa.array(np.full(len(c), at, np.int32)), pa.array(place)], [*b.schema.names, *names, "at", "place"]
            )

    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = [F.col("c"), *order]
    shape = T.StructType([*rows.schema, *(T.StructField(n, T.LongType()) for n in names)]).add("at", T.IntegerType()).add("place", T.LongType())
    dealt, _ = saved(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(local, shape), "trie-running")
    edges = dealt.groupBy("at").agg(F.min("c").alias("first"), F.max_by(F.struct("c", *names), "place").alias("last"))
    carried, before = [], None  # the last conversation so far and its totals
    for e in sorted(edges.collect(), key=lambda r: r["at"]):
        here = {n: e["last"][n] for n in names}
        if before is not None and before[0] == e["first"]:
            carried.append((e["at"], e["first"], *(before[1][n] for n in names)))
            if e["last"]["c"] == e["first"]:
                here = {n: here[n] + before[1][n] if totals[n][1] == "sum" else here[n] ^ before[1][n] for n in names}
        before = (e["last"]["c"], here)
    fields = ", ".join(f"more_{n} bigint" for n in names)
    # At most a row for each partition.
    carry = F.broadcast(spark.createDataFrame(carried, f"at int, c bigint, {fields}"))
    zero = F.lit(0).cast("bigint")
    added = {
        n: F.col(n) + F.coalesce(f"more_{n}", zero) if totals[n][1] == "sum" else F.col(n).bitwiseXOR(F.coalesce(f"more_{n}", zero))
        for n in names
    }
    return dealt.join(carry, ["at", "c"], "left").withColumns(added).select(*rows.columns, *names)


def paths(conversations: DataFrame) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: ``c, depth, n`` (of
    the last turn), ``size`` (turns of the whole), and the digests of the
    prefix (``p1, p2``) and its parent (``q1, q2``). The empty prefix has depth 0
    and digest 0."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    order = [F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2"), F.col("n")]
    numbered = running(turn_digests(conversations).withColumn("one", one), order, {"number": ("one", "sum")})
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).alias("h")
    turns = numbered.select("c", (F.col("number") - 1).alias("pos"), "d1", "d2", "n", h)
    # The first turns of bases, at most HEADS - 1 each, and the conversations.
    turn = F.struct("pos", "d1", "d2", "n")
    heads = turns.where((F.col("c") % GROUP == 0) & (F.col("pos") < HEADS - 1)).groupBy(F.col("c").alias("b")).agg(
        F.array_sort(F.collect_list(turn)).alias("head")
    )
    own = turns.groupBy("c", "h").agg(F.count(F.lit(1)).alias("own"))
    whole = own.withColumn("b", F.col("c") - F.col("c") % GROUP).join(heads, "b", "left")
    head = F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType))
    whole = whole.select("c", head.alias("head"), F.greatest(F.col("own") - F.col("h"), zero).alias("rest"))
    whole, _ = saved(whole.withColumn("size", F.size("head") + F.col("rest")), "trie-conversations")
    root = F.array(F.struct(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), zero.alias("n")))
    taken = F.transform("head", lambda x: F.struct((x["pos"] + 1).alias("depth"), x["d1"], x["d2"], x["n"]))
    fronts = whole.select("c", "size", F.explode(F.concat(root, taken)).alias("t")).select("c", "t.depth", "t.d1", "t.d2", "t.n", "size")
    rests = turns.where(F.col("pos") >= F.col("h")).join(whole.select("c", "size", F.size("head").alias("from")), "c").select(
        "c", (F.col("pos") - F.col("h") + F.col("from") + 1).cast("bigint").alias("depth"), "d1", "d2", "n", "size"
    )
    rows = fronts.unionByName(rests)
    mixed = {"m1": F.xxhash64("depth", "d1", "d2"), "m2": F.xxhash64("d2", "d1", "depth")}
    rows = rows.withColumns({k: F.when(F.col("depth") == 0, zero).otherwise(m) for k, m in mixed.items()})
    along = running(rows.select("c", "depth", "n", "size", "m1", "m2"), [F.col("depth")], {"p1": ("m1", "xor"), "p2": ("m2", "xor")})
    return along.select(
        "c", "depth", "n", "size", "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("m1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("m2")).alias("q2"),
    )


# --- the sketch ---------------------------------------------------------------


def _places(p1: np.ndarray, p2: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each prefix in every row of the sketch, which has ``width``
    cells (a power of two)."""
    a, b = p1.view(np.uint64), p2.view(np.uint64)
    return [((a + np.uint64(2 * r) * b) & np.uint64(width - 1)).astype(np.int64) + r * width for r in range(ROWS)]


def _packed(cells: np.ndarray) -> np.ndarray:
    """Counts of 0, 1 and 2 (or more) in two bits each."""
    four = cells.reshape(-1, 4)
    return four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6


def _unpacked(packed: np.ndarray) -> np.ndarray:
    return ((packed[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(-1)


def sketch(prefixes: DataFrame, width: int) -> bytes:
    """The count-min sketch of ``p1, p2``, saturated at two, as packed bytes.

    Every task counts its own rows and sends the segments that have counts,
    compressed; a segment is summed in one place, from one row a task."""
    step = min(SEGMENT, width)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(ROWS * width, np.uint8)
        for b in batches:
            p1, p2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("p1", "p2"))
            for place in _places(p1, p2, width):
                # A cell named twice in a batch, or before, is at two.
                one, times = np.unique(place, return_counts=True)
                cells[one] = np.minimum(2, cells[one] + np.minimum(times, 2))
        pack = zstandard.ZstdCompressor(level=1).compress
        for at in range(0, len(cells), step):
            part = cells[at : at + step]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([pack(_packed(part).tobytes())])], ["at", "body"])

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        at, total = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_packed(total).tobytes()])], ["at", "body"])

        for b in batches:
            for here, body in zip(b.column("at").to_pylist(), b.column("body").to_pylist()):
                if here != at:
                    if at is not None:
                        yield row()
                    at, total = here, np.zeros(step, np.uint8)
                total = np.minimum(2, total + _unpacked(np.frombuffer(unpack(body), np.uint8)))
        if at is not None:
            yield row()

    shape = "at bigint, body binary"
    parts = prefixes.select("p1", "p2").mapInArrow(counted, shape).repartition("at").sortWithinPartitions("at")
    out = bytearray(ROWS * width // 4)
    for r in parts.mapInArrow(summed, shape).toLocalIterator():
        out[r["at"] // 4 : r["at"] // 4 + len(r["body"])] = r["body"]
    return bytes(out)


def screened(rows: DataFrame, cells: bytes, width: int) -> DataFrame:
    """``rows`` with ``single`` and ``single_parent``: whether the sketch proves that
    the prefix and its parent have one member."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)
    names = rows.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)

        def single(b, one, two, depth):
            p1, p2 = (b.column(c).to_numpy(zero_copy_only=False) for c in (one, two))
            least = np.full(len(p1), 3, np.uint8)
            for place in _places(p1, p2, width):
                least = np.minimum(least, packed[place >> 2] >> ((place & 3) * 2).astype(np.uint8) & 3)
            return pa.array((least == 1) & (depth > 0))

        for b in batches:
            depth = b.column("depth").to_numpy(zero_copy_only=False)
            more = [single(b, "p1", "p2", depth), single(b, "q1", "q2", depth - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*names, "single", "single_parent"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, single boolean, single_parent boolean")


def sketch_width(n: int) -> int:
    """Cells of a row for ``n`` prefixes: a power of two within the bounds."""
    total = MIN_CELLS
    while total < min(MAX_CELLS, n * CELLS_EACH):
        total *= 2
    return total // ROWS


# --- ids that end at a node -----------------------------------------------------


def ends_hashes(ends: DataFrame) -> DataFrame:
    """``p1, p2, sha`` from ``p1, p2, c``: SHA-256 of each node's ids in
    ascending order, comma-joined."""
    keys = ["p1", "p2"]

    def runs(batches: Iterable[pa.RecordBatch]):
        """Rows of equal keys that follow each other, in pieces of a batch."""
        for b in batches:
            if b.num_rows:
                p1, p2 = (b.column(c).to_numpy(zero_copy_only=False) for c in keys)
                edge = np.flatnonzero(np.r_[True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])])
                for a, z in zip(edge.tolist(), [*edge[1:].tolist(), b.num_rows]):
                    yield (int(p1[a]), int(p2[a])), b, a, z

    def joined(batches):
        names, kinds = [*keys, "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        rows: list[tuple] = []
        key, held = None, []

        def out(force):
            nonlocal rows
            if rows and (force or len(rows) >= 1024):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows = []

        def close():
            if held:
                rows.append((*key, held[0], ",".join(map(str, held)).encode()))

        for now, b, a, z in runs(batches):
            ids = b.column("c").slice(a, z - a).to_pylist()
            if now != key:
                close()
                key, held = now, []
            held += ids
            while len(held) > CHUNK_IDS:
                rows.append((*key, held[0], ",".join(map(str, held[:CHUNK_IDS])).encode()))
                held = held[CHUNK_IDS:]
            yield from out(False)
        close()
        yield from out(True)

    def hashed(batches):
        key, state, rows = None, None, []
        for now, b, a, z in runs(batches):
            if now != key:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = now, None
            for ids in b.column("ids").slice(a, z - a).to_pylist():
                if state is None:
                    state = hashlib.sha256(ids)
                else:
                    state.update(b","), state.update(ids)
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*keys, "sha"])
                rows = []
        if key is not None:
            rows.append((*key, state.hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*keys, "sha"])

    parts = max(2, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [*keys, "c"]
    chunks = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        joined, "p1 bigint, p2 bigint, first bigint, ids binary"
    )
    return chunks.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(hashed, "p1 bigint, p2 bigint, sha string")


# --- the trie -----------------------------------------------------------------


def nodes(conversations: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id`` (smallest member), ``depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    rows = paths(conversations)
    width = sketch_width(rows.count())
    cells = sketch(rows.where("depth > 0"), width)
    seen = screened(rows, cells, width)
    # Prefixes that may be shared, and the single ones just below them.
    kept, _ = saved(seen.where("not single or not single_parent"), "trie-shared")
    shared, entries = kept.where("not single"), kept.where("single")

    groups, _ = saved(
        shared.groupBy("p1", "p2").agg(
            F.min("c").alias("conv_id"), F.min("depth").alias("depth"), F.min("n").alias("n"),
            F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.count(F.lit(1)).alias("n_convs"),
            F.max("size").alias("longest"), F.min("single_parent").alias("single_parent"),
        ),
        "trie-groups",
    )
    # What each node adds to its own subtree sums and those above it, at its
    # smallest member's row, and along that member's path.
    zero = F.lit(0).cast("bigint")
    leaf = (F.col("longest") == F.col("depth")).cast("bigint")
    own = groups.select(F.col("conv_id").alias("c"), "depth", leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("n")).alias("saved"))
    # A single leaf, written where it lies, is one more leaf for all above it.
    ends = seen.where("single and depth = size").select("c", "depth", F.lit(1).cast("bigint").alias("leaf"), zero.alias("saved"))
    nothing = F.lit(None).cast("bigint")
    places = shared.select("c", "depth", zero.alias("leaf"), zero.alias("saved"), "p1", "p2", F.lit(1).alias("shared"))
    gains = own.unionByName(ends).withColumns({"p1": nothing, "p2": nothing, "shared": F.lit(0)})
    sums = running(
        gains.unionByName(places), [F.col("depth").desc(), F.col("shared")], {"leaves": ("leaf", "sum"), "savings": ("saved", "sum")}
    ).where("shared = 1").select("p1", "p2", F.col("leaves").alias("leaf"), F.col("savings").alias("saved"))
    children = groups.where("depth > 0 and not single_parent").select("q1", "q2").unionByName(entries.select("q1", "q2"))
    totals = sums.withColumn("child", zero).unionByName(
        children.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), zero.alias("leaf"), zero.alias("saved"), F.lit(1).cast("bigint").alias("child"))
    ).groupBy("p1", "p2").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("child").alias("n_children")
    )
    hashes = ends_hashes(shared.where("depth = size").select("p1", "p2", "c"))
    several = groups.join(totals, ["p1", "p2"]).join(hashes, ["p1", "p2"], "left").select(
        "conv_id", "depth", "q1", "q2", "single_parent", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    ends_here = F.col("depth") == F.col("size")
    alone = [
        F.col("c").alias("conv_id"), "depth", F.lit(1).cast("bigint").alias("n_convs"),
        F.when(ends_here, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(ends_here, F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(F.lit(_EMPTY)).alias("ends_sha256"),
    ]
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    # Written where they lie: nodes below a node with the same one member.
    tails = seen.where("single and single_parent").select(*alone, F.col("c").alias("parent_conv_id"))
    known = several.where("single_parent").withColumn("parent_conv_id", F.col("conv_id"))
    root = several.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    # The others ask the exact groups for their parent; a parent with many
    # children is a skewed key, which AQE splits.
    asking = several.where("depth > 0 and not single_parent").drop("single_parent").unionByName(
        entries.select(*alone, "q1", "q2")
    )
    parents = groups.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    asked = asking.join(parents, ["q1", "q2"], "left")
    out = tails.select(*columns)
    for part in (known, root, asked):
        out = out.unionByName(part.select(*columns))
    return out
