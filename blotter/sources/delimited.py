"""Delimited-file readers for the incident extract and the code lookup.

Columns are bound by the names in each file's own header, never by position, so
an extract with more columns or in another order gives the same rows; a needed
column that is absent is an error. All columns are strings (no inference).

The input may be a file, a directory of part files, or several of these. Their
files are grouped by their header lines (one short read of each file, several
at a time), each group is one scan bound by its own header, and the groups are
put together by name. Files of one header, the usual case, are one scan of the
path as given.

Which rows ``DROPMALFORMED`` drops depends on the session setting
``spark.sql.csv.parser.columnPruning.enabled``: with pruning on (Spark's
default) only selected columns are checked; ``session.STRICT_MALFORMED_CONF``
turns it off so every row is checked against the full header.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from blotter import schema as S

#: Files whose header lines are read at a time.
HEADER_READERS = 16

#: The column of a row's text where the row does not fit the header.
DAMAGED = "_damaged"


class MissingInputError(FileNotFoundError):
    """The input path does not exist."""


class MissingColumnError(ValueError):
    """The input's header lacks a column that the job needs."""


def checked_read(path: str | list[str], read):
    """``read(path)``, with a clear error where the path does not exist."""
    try:
        return read(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingInputError(f"Invalid input path: {path}") from exc
        raise


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a reader of ``path`` (a pattern, too) reads: files named by
    it, and those directly in a directory whose names do not mark them as hidden."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    tops = list(fs.globStatus(p) or [])
    if not tops:
        raise MissingInputError(f"Invalid input path: {path}")
    found = [f for top in tops for f in ([top] if top.isFile() else fs.listStatus(top.getPath()))]
    shown = [f for f in found if f.isFile() and f.getLen() and f.getPath().getName()[0] not in "._"]
    return sorted(f.getPath().toString() for f in shown)


def header_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file that is not blank (compressed files too)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    raw = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        stream = raw if codec is None else codec.createInputStream(raw)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        raw.close()


def header_groups(spark: SparkSession, path: str | list[str]) -> list[tuple[str | None, str | list[str]]]:
    """``path`` as inputs of one header each, with that header line."""
    paths = [path] if isinstance(path, str) else list(path)
    files = [f for one in paths for f in data_files(spark, one)]
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda f: header_line(spark, f), files))
    groups: dict[str, list[str]] = {}
    for f, header in zip(files, headers):
        if header is not None:
            groups.setdefault(header, []).append(f)
    return [(next(iter(groups), None), path)] if len(groups) < 2 else list(groups.items())


def _reader(spark: SparkSession, sep: str, mode: str) -> DataFrameReader:
    return (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("mode", mode)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _bound(df: DataFrame, path: str | list[str], columns: tuple[str, ...], sep: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        where = path if isinstance(path, str) else ", ".join(path)
        raise MissingColumnError(f"{where}: no column {', '.join(absent)} in the header {sep.join(df.columns)}")
    return df.select(*[df[f"`{c}`"] for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: tuple[str, ...],
    sep: str = ";",
    mode: str = "DROPMALFORMED",
) -> DataFrame:
    """Quote-aware ``sep``-delimited scan of the headers' ``columns``.

    Leading and trailing whitespace is kept (codes such as ``' 03'`` must
    survive unchanged); cleaning is an explicit later step.
    """
    reader = _reader(spark, sep, mode)
    parts = [_bound(checked_read(p, reader.csv), p, columns, sep) for _, p in header_groups(spark, path)]
    return reduce(DataFrame.unionByName, parts)


def read_parsed(spark: SparkSession, path: str | list[str], columns: tuple[str, ...], sep: str = ";") -> DataFrame:
    """``columns`` of every row and, in ``DAMAGED``, the line of rows that have
    more or fewer fields than their file's header (null in whole rows).

    One permissive parse of all fields of each line: the rows without ``DAMAGED``
    are those that a strict ``DROPMALFORMED`` keeps, and the others are what it
    drops without a trace. Blank lines are no rows; lines that equal the header
    are none either, wherever they stand."""
    parts = []
    for header, p in header_groups(spark, path):
        names = checked_read(p, _reader(spark, sep, "PERMISSIVE").csv).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, DAMAGED]])
        options = {
            "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        }
        lines = checked_read(p, spark.read.text).where((F.trim("value") != "") & (F.col("value") != F.lit(header or "")))
        row = F.from_csv("value", F.lit(schema.toDDL()), options)
        df = lines.select(row.alias("row")).select("row.*")
        parts.append(_bound(df, p, (*columns, DAMAGED), sep))
    return reduce(DataFrame.unionByName, parts)


def split_damaged(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole rows of :func:`read_parsed`, and the texts of the others (``line``)."""
    whole = parsed.where(F.col(DAMAGED).isNull()).drop(DAMAGED)
    return whole, parsed.where(F.col(DAMAGED).isNotNull()).select(F.col(DAMAGED).alias("line"))


def canonical(df: DataFrame) -> DataFrame:
    """Rename known source headers to the canonical lower-case names."""
    return df.select([df[c].alias(S.CANONICAL.get(c, c)) for c in df.columns])


def incident_columns(with_description: bool = True) -> tuple[str, ...]:
    """The extract's columns that the questions use, as its header names them."""
    names = [h for h in S.INCIDENT_HEADER if h in S.CANONICAL]
    return tuple(h for h in names if with_description or h not in S.DESCRIPTIVE_COLUMNS)


def read_incidents(
    spark: SparkSession,
    path: str | list[str],
    with_description: bool = True,
    mode: str = "DROPMALFORMED",
) -> DataFrame:
    """The extract's columns that the questions use, under canonical names:
    ``iucr, primary_type, description, arrest, district, year``, the two
    descriptive ones only ``with_description``."""
    return canonical(read_delimited(spark, path, incident_columns(with_description), mode=mode))


def read_extract(spark: SparkSession, path: str | list[str], mode: str = "DROPMALFORMED") -> DataFrame:
    """Every column of the extract, as named in its header, for preparation.
    Files whose headers differ in order are put together by name; files whose
    headers have other names are an error."""
    groups = [p for _, p in header_groups(spark, path)]
    parts = [checked_read(p, _reader(spark, ";", mode).csv) for p in groups]
    for p, part in zip(groups, parts):
        if set(part.columns) != set(parts[0].columns):
            raise MissingColumnError(f"{p}: the header {';'.join(part.columns)} has other columns than {';'.join(parts[0].columns)}")
    return reduce(DataFrame.unionByName, parts)


def read_codes(spark: SparkSession, path: str | list[str], mode: str = "DROPMALFORMED") -> DataFrame:
    """The code lookup: ``iucr, primary_description, secondary_description``."""
    return canonical(read_delimited(spark, path, S.CODE_HEADER, mode=mode))
