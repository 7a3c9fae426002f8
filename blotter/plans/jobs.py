"""File-to-file jobs: the workload as a user runs it on a cluster.

Each job reads delimited input (the incident extract, the code lookup) or a
Parquet copy of it, runs one lazy plan and writes the result, replacing any
previous output. Command line::

    python -m blotter.plans.jobs count       IN OUT [--clean] [--lines [--partitions N]] [--single-file]
                                             [--counters] [--rejects DIR]
    python -m blotter.plans.jobs count-join  IN CODES OUT [--how left|inner]
                                             [--strategy auto|broadcast|merge]
                                             [--clean] [--normalize whitespace|full]
                                             [--lines [--one-scan]] [--single-file]
    python -m blotter.plans.jobs arrest-rate IN OUT [--exact] [--partitions N [--split-points FILE]]
                                             [--text] [--lines] [--single-file]
    python -m blotter.plans.jobs drop-columns IN OUT [--single-file]
    python -m blotter.plans.jobs normalize-codes CODES OUT
    python -m blotter.plans.jobs to-parquet  IN OUT [--no-description]

``IN`` may be a file or a directory of part files. A folder with Parquet
files (as ``to-parquet`` writes) is read as Parquet, whatever its name;
``--format`` says otherwise. ``--strict`` checks every column of a delimited
row, so rows with too few or too many fields are dropped; ``--rejects`` does so
too, writes the dropped lines to a folder and prints how many there are.
``--split-points`` partitions the rates by the points stored in FILE, or by
those of a sample, which are stored there first. ``--counters`` prints the run's
records in, combined, groups and out. An option that the chosen form of a job
does not use is an error.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions import normalize_code, null_to_empty
from blotter.operators import Counters, natural_key_sort, partition_by_points, points_at, range_sort
from blotter.plans import compose as C
from blotter.plans import textpath as TP
from blotter.session import build_session
from blotter.sinks import (
    export_single_file,
    record_line,
    without_descriptions,
    write_codes,
    write_delimited,
    write_lines,
)
from blotter.sources import (
    MissingColumnError,
    MissingInputError,
    canonical,
    checked_read,
    incident_columns,
    read_codes,
    read_extract,
    read_incidents,
    read_parsed,
    split_damaged,
)

# The line rate job's reducer count.
RATE_PARTITIONS = 9


def _write_result(df: DataFrame, dst: str, single_file: bool) -> None:
    """A ';' result without header: parallel part files, or one file."""
    if single_file:
        export_single_file(df, dst)
    else:
        write_delimited(df, dst)


def is_parquet(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a Parquet file or a folder that holds some."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise MissingInputError(f"Invalid input path: {path}")
    return any(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(p))


def load_incidents(
    spark: SparkSession, path: str, with_description: bool = True, fmt: str | None = None
) -> DataFrame:
    """Canonical incidents from the ';' extract or its Parquet copy; ``fmt``
    (``csv`` or ``parquet``) overrides what the files say."""
    if fmt == "parquet" or fmt is None and is_parquet(spark, path):
        return checked_read(path, spark.read.parquet)
    return read_incidents(spark, path, with_description=with_description)


def to_parquet(spark: SparkSession, src: str, dst: str, with_description: bool = True) -> None:
    """One-off conversion of the extract (22 columns, or 20 without the
    descriptive ones) to Parquet with canonical column names, so repeated
    jobs scan only the columns they use instead of parsing text."""
    read_incidents(spark, src, with_description=with_description).write.mode("overwrite").parquet(dst)


def count(
    spark: SparkSession,
    src: str,
    dst: str,
    clean: bool = False,
    lines: bool = False,
    single_file: bool = False,
    fmt: str | None = None,
    partitions: int | None = None,
    counters: Counters | None = None,
    rejects: str | None = None,
) -> int | None:
    """Incidents per district and type.

    ``lines=False``: quote-aware read, optional dirty-row filters, ';' output.
    ``lines=True``: the line form -- positional split of raw lines, dirty-row
    filters (which also drop the header), records ``district;<TAB>text;count``;
    with ``partitions`` in the line job's own placement of districts.
    ``rejects``: the lines with too few or too many fields are written there;
    returns how many there are.
    """
    if not lines:
        dropped = None
        if rejects is None:
            incidents = load_incidents(spark, src, fmt=fmt)
        else:
            whole, damaged = split_damaged(read_parsed(spark, src, incident_columns()))
            seen = Counters()
            write_lines(seen.watch(damaged, "rejects"), rejects)
            dropped = seen.values()["rejects"]
            incidents = canonical(whole)
        _write_result(C.type_count_by_district(incidents, clean=clean, counters=counters), dst, single_file)
        return dropped
    counted = TP.type_count_lines_clean(spark, src)
    if partitions:
        counted = natural_key_sort(counted, partitions)
    write_lines(counted.select(record_line().alias("value")), dst)
    return None


def count_join(
    spark: SparkSession,
    src: str,
    codes_path: str,
    dst: str,
    how: str = "left",
    strategy: str = "auto",
    clean: bool = False,
    normalize: str | None = None,
    lines: bool = False,
    single_file: bool = False,
    fmt: str | None = None,
    one_scan: bool = False,
) -> None:
    """Count on the code (input without descriptions), join the lookup's
    description, sort after the join, write ``district;description;count``.

    ``lines=True``: the line form -- counts from the raw lines of the
    extract (dirty rows removed), joined to the lookup file's lines on
    whitespace-free codes (inner, reduce-side); output
    records ``district;<TAB>description;count``. ``one_scan`` reads both inputs in
    one scan and joins them by one exchange of tagged records.
    """
    if lines:
        if one_scan:
            joined = TP.one_scan_join(spark, src, codes_path)
        else:
            joined = TP.tagged_cogroup_join(spark, TP.line_code_counts(spark, src), codes_path)
        write_lines(joined.select(record_line().alias("value")), dst)
        return
    facts = load_incidents(spark, src, with_description=False, fmt=fmt)
    codes = read_codes(spark, codes_path)
    result = C.type_count_with_lookup(
        facts, codes, how=how, strategy=strategy, clean=clean, normalize=normalize
    )
    _write_result(result, dst, single_file)


def arrest_rate(
    spark: SparkSession,
    src: str,
    dst: str,
    exact: bool = False,
    partitions: int | None = None,
    text: bool = False,
    lines: bool = False,
    single_file: bool = False,
    fmt: str | None = None,
    split_points: str | None = None,
) -> None:
    """Arrest percentage per year and type.

    Default: rounded, exact-case, per ``(year, code, description)``, output
    ``year;description;pct`` in year order. ``exact``: unrounded, any-case,
    per ``(year, code)``; with ``partitions`` the output is a total order over
    that many range partitions. ``text`` writes ``year<TAB>code <TAB>pct``.
    ``lines`` (implies ``exact``) reads raw lines by position instead of the
    quote-aware reader, as the line job does, into nine range partitions
    unless ``partitions`` says otherwise. ``split_points``: part ``i`` of the exact
    form holds the keys of range ``i`` of the points stored in that file (those of
    a bounded sample where there is none yet).
    """
    if lines:
        result = TP.arrest_rate_lines(spark, src, partitions or RATE_PARTITIONS)
    elif not exact:
        _write_result(C.arrest_pct(load_incidents(spark, src, fmt=fmt)), dst, single_file)
        return
    else:
        incidents = load_incidents(spark, src, with_description=False, fmt=fmt)
        keys = ("year", "iucr")
        if split_points:
            rates = C.arrest_rates_exact(incidents)
            result = partition_by_points(rates, keys, points_at(rates, keys, partitions or RATE_PARTITIONS, split_points))
        elif partitions:
            result = range_sort(C.arrest_pct_exact(incidents), partitions, keys)
        else:
            result = C.arrest_pct_exact(incidents)
    if text:
        line = F.format_string(
            "%s\t%s \t%s",
            null_to_empty(F.col("year").cast("string")),
            null_to_empty("iucr"),
            null_to_empty(F.col("pct").cast("string")),
        )
        write_lines(result.select(line.alias("value")), dst)
    else:
        _write_result(result, dst, single_file)


def drop_columns(spark: SparkSession, src: str, dst: str, single_file: bool = False) -> None:
    """Write the extract without its descriptive columns, with a header: all
    other columns of the input, in its order."""
    slim = without_descriptions(read_extract(spark, src))
    if single_file:
        export_single_file(slim, dst, header=True)
    else:
        write_delimited(slim, dst, header=True)


def normalize_codes(spark: SparkSession, codes_path: str, dst: str) -> None:
    """The lookup with whitespace-free, zero-padded codes, with a header."""
    codes = read_codes(spark, codes_path)
    write_codes(codes.withColumn("iucr", normalize_code("iucr")), dst)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="blotter.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, single_file: bool = True) -> argparse.ArgumentParser:
        one = sub.add_parser(name)
        for path in paths:
            one.add_argument(path)
        one.add_argument("--strict", action="store_true")
        if single_file:
            one.add_argument("--single-file", action="store_true")
        return one

    c = job("count", "src", "dst")
    c.add_argument("--clean", action="store_true"), c.add_argument("--lines", action="store_true")
    c.add_argument("--partitions", type=int), c.add_argument("--rejects")
    c.add_argument("--counters", action="store_true")
    j = job("count-join", "src", "codes", "dst")
    j.add_argument("--how", choices=["left", "inner"])
    j.add_argument("--strategy", choices=["auto", "broadcast", "merge"])
    j.add_argument("--clean", action="store_true")
    j.add_argument("--normalize", choices=["whitespace", "full"])
    j.add_argument("--lines", action="store_true"), j.add_argument("--one-scan", action="store_true")
    a = job("arrest-rate", "src", "dst")
    a.add_argument("--exact", action="store_true"), a.add_argument("--partitions", type=int)
    a.add_argument("--text", action="store_true"), a.add_argument("--lines", action="store_true")
    a.add_argument("--split-points")
    for one in (c, j, a):
        one.add_argument("--format", choices=["csv", "parquet"])
    job("drop-columns", "src", "dst")
    job("normalize-codes", "codes", "dst", single_file=False)
    t = job("to-parquet", "src", "dst", single_file=False)
    t.add_argument("--no-description", action="store_true")
    return p


#: Options that a form of a job does not use: (job, when given, unused then).
_UNUSED = (
    ("count", "lines", ("clean", "single_file", "format", "strict", "counters", "rejects")),
    ("count", "rejects", ("format", "strict")),
    ("count-join", "lines", ("how", "strategy", "clean", "normalize", "single_file", "format", "strict")),
    ("arrest-rate", "lines", ("exact", "format", "strict", "split_points")),
    ("arrest-rate", "split_points", ("single_file",)),
    ("arrest-rate", "text", ("single_file",)),
)


def _check(p: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    """Reject options that would be ignored."""
    for job, given, unused in _UNUSED:
        if args.job == job and getattr(args, given):
            for name in unused:
                if getattr(args, name):
                    p.error(f"--{name.replace('_', '-')} has no effect with --{given}")
    if args.job == "arrest-rate" and not (args.exact or args.lines) and (args.text or args.partitions or args.split_points):
        p.error("--text, --partitions and --split-points need --exact or --lines")
    if args.job == "count-join" and args.one_scan and not args.lines:
        p.error("--one-scan needs --lines")
    if args.job == "count" and args.partitions and not args.lines:
        p.error("--partitions needs --lines")


def main(argv: list[str] | None = None) -> int:
    p = _parser()
    args = p.parse_args(argv)
    _check(p, args)

    spark = build_session(app_name=f"blotter-{args.job}", strict_malformed=args.strict)
    try:
        if args.job == "count":
            counters = Counters() if args.counters else None
            dropped = count(
                spark, args.src, args.dst, args.clean, args.lines, args.single_file, args.format, args.partitions, counters,
                args.rejects,
            )
            if dropped is not None:
                print(f"rejects\t{dropped}")
            for name, n in (counters.values() if counters else {}).items():
                print(f"{name}\t{n}")
        elif args.job == "count-join":
            count_join(
                spark, args.src, args.codes, args.dst, args.how or "left", args.strategy or "auto",
                args.clean, args.normalize, args.lines, args.single_file, args.format, args.one_scan,
            )
        elif args.job == "arrest-rate":
            arrest_rate(
                spark, args.src, args.dst, args.exact, args.partitions, args.text, args.lines, args.single_file, args.format,
                args.split_points,
            )
        elif args.job == "drop-columns":
            drop_columns(spark, args.src, args.dst, args.single_file)
        elif args.job == "normalize-codes":
            normalize_codes(spark, args.codes, args.dst)
        elif args.job == "to-parquet":
            to_parquet(spark, args.src, args.dst, with_description=not args.no_description)
    except (MissingInputError, MissingColumnError) as exc:
        print(exc, file=sys.stderr)
        return 2
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
