"""The incident view over the driver's TPC-H-style tables.

The driver ships no crime extract, so the incident table and the code lookup
are derived from ``lineitem`` and ``part`` by Spark itself, lazily in every
query: a changed input gives changed results, and the work grows with the
tables.

Fact rows: one incident per ``lineitem`` row.

* ``iucr``     -- ``l_partkey`` as a code of four characters or more
* ``district`` -- ``l_suppkey mod 25`` as three characters; dirty values are
  injected like those of the real extract: ``'true'`` (a shifted boolean
  field), ``' 01'`` (leading space) and null (empty field)
* ``arrest``   -- from ``l_returnflag``: ``'true'``, ``'false'`` or ``'True'``
  (the last separates exact-case from any-case tests); null in some rows
* ``year``     -- year of ``l_shipdate`` as text; ``'n/a'`` in some rows
* ``primary_type``, ``description`` -- the lookup entry of the code

Code lookup: one entry for every ``part`` row. Some descriptions hold the
damaged quoted fragment that the line jobs filter, some a separator inside
quotes. The lookup "as shipped" keeps two defects the real file had: some
codes lack their leading zeros and some carry trailing whitespace, so joins
without normalisation leave codes unmatched.

Text files (:func:`text_file`) are written only for the queries whose
feature is reading a file. They are kept for a session as long as the input
files have the same names, sizes and times, and :func:`release` removes them.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schema as S
from blotter.functions import pad_code
from blotter.operators.joins import join_lookup
from blotter.session import release_kept, scratch_dir, scratch_path
from blotter.sinks import as_extract, write_codes, write_delimited, write_extract, write_lines

# Fixed values of the mapping (chosen for this library, not taken from the
# reference): district domain and the periods of dirty rows.
N_DISTRICTS = 25
CODE_WIDTH = 4
DISTRICT_WIDTH = 3
TRUE_DISTRICT_PERIOD = 101      # l_orderkey multiple -> district 'true'
SPACED_DISTRICT_PERIOD = 103    # -> district ' 01'
NULL_DISTRICT_PERIOD = 107      # -> district null
NULL_ARREST_PERIOD = 109        # -> arrest null
BAD_YEAR_PERIOD = 113           # -> year 'n/a'
CUT_LINE_PERIOD = 127           # -> one more line, cut off behind the code
BLANK_LINE_PERIOD = 131         # -> one more line, blank
UNPADDED_CODE_CLASS = 7         # p_partkey mod 20 -> shipped without zeros
SPACED_CODE_CLASS = 13          # p_partkey mod 20 -> shipped with a trailing space
DAMAGED_TEXT_CLASS = 17         # p_partkey mod 50 -> damaged description
SEPARATOR_TEXT_CLASS = 23       # p_partkey mod 50 -> separator in the description
DAMAGED_TEXT = '"THEFT BY LESSEE, '
SEPARATOR_TEXT = "; OTHER"

#: How the extracts are written. Most of a line are empty fields, so gzip takes
#: most of it away. A reader cannot split such a file and puts small ones together
#: by their size, each as 4 MB more than it has (``spark.sql.files.openCostInBytes``);
#: so many rows a file give a reading task about as many lines as 128 MB of plain
#: text have.
EXTRACT_FILES = {"compression": "gzip", "maxRecordsPerFile": 125_000}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(c):
    return pad_code(c.cast("string"), CODE_WIDTH)


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    text = (
        F.when(k % 50 == DAMAGED_TEXT_CLASS, F.concat(F.lit(DAMAGED_TEXT), "p_name"))
        .when(k % 50 == SEPARATOR_TEXT_CLASS, F.concat("p_name", F.lit(SEPARATOR_TEXT)))
        .otherwise(F.col("p_name"))
    )
    return _table(spark, sf_dir, "part").select(
        k.alias("k"), F.col("p_type").alias("primary_description"), text.alias("secondary_description")
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean lookup: ``iucr, primary_description, secondary_description``."""
    return _lookup(spark, sf_dir).select(_code(F.col("k")).alias("iucr"), "primary_description", "secondary_description")


def shipped_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup as shipped, with unpadded and whitespace-damaged codes."""
    k = F.col("k")
    code = (
        F.when(k % 20 == UNPADDED_CODE_CLASS, k.cast("string"))
        .when(k % 20 == SPACED_CODE_CLASS, F.concat(_code(k), F.lit(" ")))
        .otherwise(_code(k))
    )
    return _lookup(spark, sf_dir).select(code.alias("iucr"), "primary_description", "secondary_description")


def _keyed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`incident_facts` with ``k``, the number that the code is made of."""
    ok = F.col("l_orderkey")
    district = (
        F.when(ok % TRUE_DISTRICT_PERIOD == 0, F.lit("true"))
        .when(ok % SPACED_DISTRICT_PERIOD == 0, F.lit(" 01"))
        .when(ok % NULL_DISTRICT_PERIOD == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad((F.col("l_suppkey") % N_DISTRICTS).cast("string"), DISTRICT_WIDTH, "0"))
    )
    arrest = (
        F.when(ok % NULL_ARREST_PERIOD == 0, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "R", F.lit("true"))
        .when(F.col("l_returnflag") == "A", F.lit("false"))
        .otherwise(F.lit("True"))
    )
    year = F.when(ok % BAD_YEAR_PERIOD == 0, F.lit("n/a")).otherwise(F.year("l_shipdate").cast("string"))
    return _table(spark, sf_dir, "lineitem").select(
        _code(F.col("l_partkey")).alias("iucr"), arrest.alias("arrest"), district.alias("district"), year.alias("year"),
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("row_key"), F.col("l_partkey").alias("k"),
    )


def incident_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents without the descriptive columns (the 20-column extract's
    content), and ``row_key``, which names the row."""
    return _keyed_facts(spark, sf_dir).drop("k")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical incident table: ``iucr, primary_type, description, arrest,
    district, year``. The description comes by an equi-join on the number of the
    code; Catalyst broadcasts the lookup by its measured size or shuffles."""
    lookup = _lookup(spark, sf_dir).toDF("k", "primary_type", "description")
    return _keyed_facts(spark, sf_dir).join(lookup, "k", "left").select(
        "iucr", "primary_type", "description", "arrest", "district", "year"
    )


def incidents_without_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`incidents` without the descriptive columns. The lookup then only
    says how often an incident comes: once, or once for each entry of its code.
    The few codes with several entries are broadcast if they measure small, so
    the incidents are not shuffled for it, however large the lookup is."""
    several = _lookup(spark, sf_dir).groupBy("k").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    times = F.sequence(F.lit(1).cast("bigint"), F.coalesce("times", F.lit(1).cast("bigint")))
    rows = join_lookup(_keyed_facts(spark, sf_dir), several, "left", strategy="broadcast", key="k")
    return rows.select("iucr", "arrest", "district", "year", F.explode(times)).drop("col")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no records: cut off behind the code (five fields), or
    blank. One ``value`` column."""
    ok = F.col("l_orderkey")
    cut = F.concat_ws(";", "l_orderkey", "l_linenumber", F.lit(""), F.lit(""), _code(F.col("l_partkey")))
    line = F.when(ok % CUT_LINE_PERIOD == 0, cut).when(ok % BLANK_LINE_PERIOD == 0, F.lit(""))
    return _table(spark, sf_dir, "lineitem").select(line.alias("value")).where("value IS NOT NULL")


def cut_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`damaged_lines` as one column named like the extract's header, so
    that they can be written as a file with that header."""
    return damaged_lines(spark, sf_dir).toDF(";".join(S.INCIDENT_HEADER))


def _write_mixed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The extract as part files of two headers: the usual one, and the columns
    in reverse order with one more in front."""
    table = incidents(spark, sf_dir)
    usual = F.col("year") < "1995"
    write_extract(table.where(usual), path)
    rest = as_extract(table.where(~usual | F.col("year").isNull()))
    write_delimited(
        rest.select(F.lit("x").alias("Note"), *[F.col(f"`{c}`") for c in reversed(rest.columns)]), path, header=True, mode="append"
    )


def _write_cut(spark: SparkSession, sf_dir: str, path: str) -> None:
    # One column that is the whole line, so nothing is quoted or separated.
    cut_lines(spark, sf_dir).write.mode("overwrite").options(
        header=True, sep="\u0001", quote="\u0000", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


#: How each text file is written; a query's first use of it does so.
_WRITERS: dict[str, Callable[[SparkSession, str, str], None]] = {
    "extract": lambda spark, sf, path: write_extract(incidents(spark, sf), path, **EXTRACT_FILES),
    "extract_nodesc": lambda spark, sf, path: write_extract(
        incidents_without_descriptions(spark, sf), path, with_description=False, **EXTRACT_FILES
    ),
    "codes": lambda spark, sf, path: write_codes(shipped_codes(spark, sf), path),
    "damaged": lambda spark, sf, path: write_lines(damaged_lines(spark, sf), path),
    "mixed": _write_mixed,
    "cut": _write_cut,
}

_TEXT_FILES: dict[tuple, dict[str, str]] = {}
_LOCK = threading.RLock()


def _files(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))


def text_file(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The path of one text input, see ``_WRITERS``."""
    base = sf_dir.rstrip("/")
    inputs = tuple(_files(spark, f"{base}/{t}.parquet") for t in ("lineitem", "part"))
    key = (spark.sparkContext.applicationId, scratch_dir(spark), inputs)
    with _LOCK:
        paths = _TEXT_FILES.setdefault(key, {})
        if name not in paths:
            path = scratch_path(spark, name)
            _WRITERS[name](spark, sf_dir, path)
            paths[name] = path
        return paths[name]


def prepare_text(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of the text inputs of the file-reading queries: the 22-column
    extract, the 20-column extract without descriptions and the lookup file
    as shipped (all ';'-separated with a header; keys ``extract``,
    ``extract_nodesc``, ``codes``)."""
    return {name: text_file(spark, sf_dir, name) for name in ("extract", "extract_nodesc", "codes")}


def prepare_damaged(spark: SparkSession, sf_dir: str) -> str:
    """Path of the text lines that are no records."""
    return text_file(spark, sf_dir, "damaged")


def release(spark: SparkSession) -> None:
    """Remove the text files that this session's queries have written."""
    with _LOCK:
        for key in [k for k in _TEXT_FILES if k[0] == spark.sparkContext.applicationId]:
            for path in _TEXT_FILES.pop(key).values():
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    release_kept(spark)
