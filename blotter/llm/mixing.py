"""Mixing sources to target weights: floor(rate) copies of each document and
one more, drawn by a hash of the document, with the rest as its probability.

A row draws by its id, its text and its number among the rows that are equal in
id, text and source, so neither missing nor repeated ids draw all or nothing.
Only rows that have equals are brought together for their numbers, dealt over
``PARTS`` parts for each group.

Only DataFrame operations: the counts, the targets, the draw and the copies
are Spark expressions.

Defined cases: a null text has size 0 and draws like an empty one; a null id
draws like an empty one; a null source is a source of its own, last in order; a
source without words has target 0 and is not repeated; an empty table gives an
empty result; columns beyond those named are carried through :func:`repeated`,
whatever their names, and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from blotter.llm.common import numbered, saved, whole_rows

#: Fixed values of the contract: weights in turn over the sources in code
#: point order, and how often a source may be repeated.
WEIGHTS = (1, 2, 3)
MAX_RATE = 3

#: Parts into which the rows of every source are dealt for the join, and those
#: of every group of equal rows for their numbers.
PARTS = 64

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def key_of(doc_id: Column, text: Column, source: Column) -> tuple[Column, Column]:
    """What a row draws by (id and text), and what makes rows equal (the source
    too)."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit(""))))
    return named, F.md5(F.concat(named, F.coalesce(F.concat(F.lit(":"), source.cast("string")), F.lit(""))))


def draw(key: Column, number: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the row's key, its number among equal
    rows and the seed alone."""
    digest = F.md5(F.concat(key, F.lit(":"), number.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def with_number(rows: DataFrame) -> DataFrame:
    """``rows`` with ``number``, from 0 among the rows of equal ``same``.

    Rows without equals are 0 where they lie. The others are written with a
    part, numbered inside each part, and moved on by the counts of the parts
    before it; a group of equal rows is never one task."""
    again, _ = saved(rows.groupBy("same").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("same").alias("again")), "mix-equal")
    zero = F.lit(0).cast("bigint")
    if not again.limit(1).count():
        return rows.withColumn("number", zero)
    on = rows["same"] == again["again"]
    part = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int")
    many, _ = saved(rows.join(again, on, "left_semi").withColumn("part", part), "mix-repeated")
    before = W.partitionBy("same").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = many.groupBy("same", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = parts.select("same", "part", F.coalesce(F.sum("n").over(before), zero).alias("start"))
    inside = F.row_number().over(W.partitionBy("same", "part").orderBy(F.lit(0))) - 1
    counted = many.withColumn("inside", inside).join(starts, ["same", "part"])
    numbers = counted.withColumn("number", (F.col("start") + F.col("inside")).cast("bigint")).select(*rows.columns, "number")
    return rows.join(again, on, "left_anti").withColumn("number", zero).unionByName(numbers)


def targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``source, source_size, target, rate`` from ``source, size`` rows.

    Every source's share of all words is its weight; a target stops at
    ``max_rate`` times its source and the excess goes to the others by
    weight. Each round fixes the sources above their bound from two totals;
    a source once fixed stays so, and rounds end when none is above.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("pos") % len(weights)).cast("int") + 1)
    table, _ = saved(
        numbered(found, "source").withColumn("weight", weight).withColumn("bound", F.col("source_size") * max_rate),
        "mix-weights",
    )
    level, fixed = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("bound") <= F.lit(level) * F.col("weight")
        t = table.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(above, F.col("bound")).otherwise(0)).alias("bound"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(above.cast("int")).alias("fixed"),
        ).first()
        if not t["weight"] or t["fixed"] == fixed:
            break
        level, fixed = (t["words"] - t["bound"]) / t["weight"], t["fixed"]
    level = 0.0 if level is None else level
    target = F.least(F.lit(level) * F.col("weight"), F.col("bound").cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return table.select("source", "source_size", target.alias("target")).withColumn("rate", rate)


def with_rate(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` (with ``source``) joined to the rates of their sources.

    The sources' rows are dealt over ``PARTS`` parts, with a copy of each
    rate for each part, so a source with a third of all documents is not one
    task. Where the rates are small, Catalyst broadcasts them by their
    measured size and nothing is shuffled."""
    rates, _ = saved(rates, "mix-rates")
    copies = rates.select(
        F.col("source").alias("of"), "source_size", "target", "rate",
        F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("copy"),
    )
    dealt = rows.withColumn("deal", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int"))
    on = dealt["source"].eqNullSafe(copies["of"]) & (dealt["deal"] == copies["copy"])
    return dealt.join(copies, on).drop("of", "deal", "copy")


def copies_of(rate: Column, seed: int) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(F.col("key"), F.col("number"), seed) < rate - whole).cast("bigint")).cast("bigint")


def mix(docs: DataFrame, seed: int = 42, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies, taken`` for each row."""
    key, same = key_of(F.col("doc_id"), F.col("text"), F.col("source"))
    # Texts are read once; all that follows is a few numbers for each document.
    sized, _ = saved(
        docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), key.alias("key"), same.alias("same")), "mix-sizes"
    )
    rates = targets(sized.select("source", "size"), weights, max_rate)
    joined = with_rate(with_number(sized), rates)
    return joined.withColumn("copies", copies_of(F.col("rate"), seed)).select(
        "doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def repeated(docs: DataFrame, seed: int = 42, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """The mix itself: each document as often as it is taken, same columns."""
    rates = targets(docs.select("source", size_of(F.col("text")).alias("size")), weights, max_rate)
    key, same = key_of(F.col("row.doc_id"), F.col("row.text"), F.col("row.source"))
    rows = whole_rows(docs).select("row", F.col("row.source").alias("source"), key.alias("key"), same.alias("same"))
    copies = copies_of(F.col("rate"), seed).cast("int")
    taken = with_rate(with_number(rows), rates).withColumn("copies", copies).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
