"""Line-oriented sources: one record per text line, parsed by position.

These reproduce the text-record path of the line-oriented jobs: a line is split
on a literal separator and fields are taken by index. A short line is dropped
(or, by option, yields null fields) rather than failing the task, and numeric fields are parsed with
``try_cast``. The header line is removed by testing a parsed field, exactly
as the line jobs do.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import line_field
from blotter.sources.delimited import MissingInputError, checked_read


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text source: a single ``value`` column, one row per line."""
    return checked_read(path, spark.read.text)


def _address(spark: SparkSession, path: str) -> str:
    """A path as the scan names its files, without the slashes after ``file:``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise MissingInputError(f"Invalid input path: {path}")
    return re.sub("^file:/+", "file:/", fs.makeQualified(p).toUri().toString()).rstrip("/")


def read_routed(spark: SparkSession, inputs: dict[str, str | list[str]]) -> DataFrame:
    """Several text inputs in one scan: ``input`` (the name that ``inputs`` gives
    to a line's file or directory) and ``value``.

    Lines are told apart by the path of their file; where one input lies inside
    another, the longer path wins, and its files are read once."""
    given = {_address(spark, p): (name, p) for name, paths in inputs.items() for p in ([paths] if isinstance(paths, str) else paths)}
    where = {address: name for address, (name, _) in given.items()}
    outer = [p for a, (_, p) in given.items() if not any(a.startswith(f"{b}/") for b in given)]
    path, name = F.col("_metadata.file_path"), None
    for address in sorted(where, key=len, reverse=True):
        here = F.lit(False)
        # The scan may write a local path with one slash or with three.
        for written in {address, re.sub("^file:/", "file:///", address)}:
            here = here | (path == written) | path.startswith(f"{written}/")
        name = F.when(here, where[address]) if name is None else name.when(here, where[address])
    return read_lines(spark, outer).select(name.alias("input"), "value")


def split_positional(
    lines: DataFrame, positions: dict[str, int], sep: str = ";", col: str = "value", keep_short: bool = False
) -> DataFrame:
    """Select fields by 0-based position from ``sep``-separated lines.

    The split is naive (no quote handling), matching the line jobs: a quoted
    separator shifts the following fields. The line is split only up to the
    field after the last one needed (the rest stays in one trailing element),
    which gives the same fields with fewer string copies.

    A line that ends before a needed field (a blank or damaged one) is no
    record and is dropped, unless ``keep_short``: then the fields it lacks
    are null.
    """
    fields = F.split(F.col(col), re.escape(sep), max(positions.values()) + 2)
    if not keep_short:
        lines = lines.where(F.size(fields) > max(positions.values()))
    return lines.select([line_field(fields, i).alias(name) for name, i in positions.items()])


def split_key_value(
    lines: DataFrame, sep: str = ";", col: str = "value", key: str = "k", value: str = "v"
) -> DataFrame:
    """Split each line at the first ``sep`` into a key and the rest.

    A line without the separator gets the whole line as key and an empty
    value.
    """
    parts = F.split(F.col(col), re.escape(sep), 2)
    return lines.select(
        line_field(parts, 0).alias(key),
        F.coalesce(line_field(parts, 1), F.lit("")).alias(value),
    )


def drop_header(df: DataFrame, column: str, marker: str, how: str = "contains") -> DataFrame:
    """Remove header lines by a test on a parsed field (``contains`` or ``equals``)."""
    c = F.col(column)
    is_header = c.contains(marker) if how == "contains" else (c == marker)
    return df.filter(c.isNull() | ~is_header)
