"""Helpers shared by the training-data operators.

Words are the maximal runs of characters other than space and U+0009 to
U+000D. On UTF-8 bytes that is exactly ``bytes.split()``, so the operators
work on the bytes of a text and never decode it: every byte of a character
beyond ASCII is above 0x7F and cannot be taken for white space.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blotter.session import scratch_path

#: Rows handled at a time inside a task: bounds what very long texts can hold.
SLICE_ROWS = 512

#: A key is hot if it holds more than this share of the rows, so there are at
#: most ``1 / HOT_SHARE`` hot keys whatever the input. Fewer rows than
#: ``HOT_ROWS`` are never worth dealing.
HOT_SHARE = 0.001
HOT_ROWS = 1000

#: Parts into which the rows of a hot key are dealt.
HOT_PARTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared scratch folder and read again, with its
    path. Cuts the lineage with files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def whole_rows(docs: DataFrame) -> DataFrame:
    """The caller's columns as one struct ``row``, so that no column an operator
    adds can clash with them; ``select("row.*")`` gives them back."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"))


def row_text(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of :func:`whole_rows` as UTF-8 bytes; null is the empty text."""
    return [b or b"" for b in batch.column("row").field("text").cast(pa.binary()).to_pylist()]


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove tables of :func:`saved` that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes; null is the empty text."""
    return [b or b"" for b in batch.column(name).cast(pa.binary()).to_pylist()]


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables in which no key is cut in two, from batches sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], side="left"))
        if cut or (held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != k[0]):
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def hot_values(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Values of ``key`` that hold more than ``share`` of the rows: fewer than
    ``1 / share`` of them, so the list is bounded whatever the input."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r[0] for r in counts.where(F.col("n") > F.lit(max(total * share, HOT_ROWS))).collect()]


def salted_join(
    rows: DataFrame, lookup: DataFrame, key: str, spread: Column, how: str = "left", hot: list | None = None
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (one row for each key) without a hot task.

    The rows of each hot key are dealt over ``HOT_PARTS`` parts by ``spread``
    and the key's one lookup row is repeated for each part; all other keys
    have one part. A caller that knows the hot keys gives them as ``hot``.
    """
    hot = hot_values(rows, key) if hot is None else hot
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    is_hot = F.coalesce(is_hot, F.lit(False))
    left = rows.withColumn("_part", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(HOT_PARTS))).otherwise(F.lit(0)))
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.withColumn("_part", F.explode(parts.cast("array<bigint>")))
    return left.withColumn("_part", F.col("_part").cast("bigint")).join(right, [key, "_part"], how).drop("_part")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``pos``, each row's place from 0 by the columns ``order``
    (nulls last; they must tell the rows apart).

    A range-partitioned table is numbered part by part; only one count for
    each part meets in a single place."""
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    by = [F.col(c).asc_nulls_last() for c in order]
    dealt, _ = saved(df.repartitionByRange(parts, *by).withColumn("_at", F.spark_partition_id()), "numbered")
    before = (
        dealt.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(W.orderBy("_at").rowsBetween(W.unboundedPreceding, -1)))
        .select("_at", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    here = F.row_number().over(W.partitionBy("_at").orderBy(*by)) - 1
    return dealt.withColumn("_here", here).join(before, "_at").withColumn(
        "pos", F.col("_before") + F.col("_here")
    ).drop("_at", "_here", "_before")


def word_blocks(docs: DataFrame, lower: bool = False, block_words: int = 1 << 20, level: int = 3) -> DataFrame:
    """Documents in blocks of about ``block_words`` words, for work on many
    words at once: ``block`` (number), ``doc_ids``, ``lens`` (words of each
    document) and ``body`` (all words with a space between, zstandard at ``level``).

    A block is a run of rows of one input partition; a longer document is a
    block of its own. Only what the blocks hold is read again later, so their
    numbers need not come out the same twice."""
    names = ["block", "doc_ids", "lens", "body"]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=level).compress
        number = TaskContext.get().partitionId() << 33
        ids, lens, parts, held = [], [], [], 0

        def block():
            row = [[number], [ids], [lens], [pack(b" ".join(p for p in parts if p))]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds)], names)

        for b in slices(batches):
            for doc, text in zip(b.column("doc_id").to_pylist(), text_bytes(b)):
                words = (text.lower() if lower else text).split()
                ids.append(doc), lens.append(len(words)), parts.append(b" ".join(words))
                held += len(words) + 1
                if held >= block_words:
                    yield block()
                    number += 1
                    ids, lens, parts, held = [], [], [], 0
        if ids:
            yield block()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "block bigint, doc_ids array<bigint>, lens array<int>, body binary")


def block_body(body: bytes) -> list[bytes]:
    """The words of a block."""
    return zstandard.ZstdDecompressor().decompress(body).split()


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WordHashes().__getitem__, words), np.uint64, len(words))
