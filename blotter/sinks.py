"""Writers: ';'-delimited files and formatted text lines.

Every writer replaces its target: the new output is written beside it and takes
its place when it is whole, so a run that fails leaves the previous output as
it was. Every writer keeps surrounding whitespace (Spark's CSV writer trims it by default,
which would turn ``' 03'`` into ``'03'``). Output stays in parallel part
files; a single file is the caller's explicit choice, joined from such parts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schema as S
from blotter.functions import null_to_empty


def replace_output(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` a staging folder beside ``path``, then swap it in.

    The swap is two renames: the old output steps aside and the new one takes
    its place; if the second fails, the old output comes back. Both folders
    have hidden names, so a reader of the parent never sees them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    p = fs.makeQualified(p)

    def beside(what: str):
        return spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{what}-{uuid.uuid4().hex}")

    staging, old = beside("staging"), beside("old")
    try:
        write(staging.toString())
        had = fs.exists(p)
        if had and not fs.rename(p, old):
            raise OSError(f"{path}: the old output cannot be moved aside")
        moved = False
        try:
            moved = fs.rename(staging, p)
        finally:
            if had and not moved:
                fs.rename(old, p)
        if not moved:
            raise OSError(f"{path}: the new output cannot be moved into place")
    finally:
        fs.delete(staging, True)
    fs.delete(old, True)


def write_delimited(
    df: DataFrame, path: str, header: bool = False, sep: str = ";", mode: str = "overwrite", **options: str | int
) -> None:
    """``sep``-delimited text with or without a header line; ``options`` are
    further ones of Spark's CSV writer."""

    def write(to: str) -> None:
        (
            df.write.mode(mode)
            .option("sep", sep)
            .option("header", header)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .options(**options)
            .csv(to)
        )

    if mode == "overwrite":
        replace_output(df.sparkSession, path, write)
    else:
        write(path)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A single string column as plain text lines."""
    if len(df.columns) != 1:
        raise ValueError("write_lines expects exactly one string column")
    if mode == "overwrite":
        replace_output(df.sparkSession, path, df.write.mode(mode).text)
    else:
        df.write.mode(mode).text(path)


def record_line(district: str = "district", text: str = "description", cnt: str = "cnt") -> Column:
    """The line jobs' output record: ``district;<TAB>text;count``.

    The key part ends in ';' and the text output format puts a tab between
    key and value, hence the tab after the first separator. Null fields are
    written as empty strings.
    """
    return F.format_string("%s;\t%s;%d", null_to_empty(district), null_to_empty(text), F.col(cnt))


def _join_files(spark: SparkSession, target, files: list) -> None:
    """``files`` in their order as one file ``target``, by the file system: a
    distributed one links their blocks, the local one copies them."""
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files:
        fs.create(target).close()
        return
    local = fs.getUri().getScheme() == "file"
    if not local:
        fs.rename(files[0], target)
        files = files[1:]
    sources = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(files))
    for i, f in enumerate(files):
        sources[i] = f
    if files:
        (fs.getRawFileSystem() if local else fs).concat(target, sources)


def can_join_files(spark: SparkSession, path: str) -> bool:
    """Whether the file system of ``path`` joins files itself."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getUri().getScheme() == "file" or fs.hasPathCapability(p, "fs.capability.paths.concat")


def export_single_file(df: DataFrame, path: str, header: bool = False, sep: str = ";") -> None:
    """Write exactly one part file with the rows in their order.

    The sorted parts are written in parallel and joined in order by the file
    system. Only one that cannot join files (an object store) gets the rows
    through one task, which streams them."""
    spark = df.sparkSession
    if not can_join_files(spark, path):
        write_delimited(df.coalesce(1), path, header=header, sep=sep)
        return
    Path = spark._jvm.org.apache.hadoop.fs.Path

    def write(to: str) -> None:
        parts = [f"{to}/_rows"]
        if header:
            parts.insert(0, f"{to}/_header")
            write_delimited(df.limit(0).coalesce(1), parts[0], header=True, sep=sep, mode="append")
        write_delimited(df, f"{to}/_rows", sep=sep, mode="append")
        fs = Path(to).getFileSystem(spark._jsc.hadoopConfiguration())
        files = []
        for part in parts:
            found = [f.getPath() for f in fs.listStatus(Path(part)) if f.getLen() and f.getPath().getName().startswith("part-")]
            files += sorted(found, key=lambda f: f.getName())
        _join_files(spark, Path(to, f"part-00000-{uuid.uuid4()}.csv"), files)
        for part in parts:
            fs.delete(Path(part), True)

    replace_output(spark, path, write)


def as_extract(incidents: DataFrame, with_description: bool = True) -> DataFrame:
    """Canonical incidents laid out as the 22-column extract (or the
    20-column one without descriptive columns); unknown columns are empty."""
    header = S.INCIDENT_SCHEMA.names if with_description else S.INCIDENT_NO_DESCRIPTION_SCHEMA.names
    known = set(incidents.columns)
    cols = []
    for name in header:
        canon = S.CANONICAL.get(name)
        src = F.col(canon) if canon in known else F.lit(None).cast("string")
        cols.append(src.alias(name))
    return incidents.select(*cols)


def write_extract(incidents: DataFrame, path: str, with_description: bool = True, **options: str | int) -> None:
    """The incident extract: header line, ';'-separated, parallel part files."""
    write_delimited(as_extract(incidents, with_description), path, header=True, **options)


def without_descriptions(extract: DataFrame) -> DataFrame:
    """The extract, as read with its own header, without descriptive columns."""
    return extract.drop(*S.DESCRIPTIVE_COLUMNS)


def write_codes(codes: DataFrame, path: str) -> None:
    """The code lookup file: header line, ';'-separated."""
    out = codes.select([F.col(S.CANONICAL[h]).alias(h) for h in S.CODE_HEADER])
    write_delimited(out, path, header=True)
