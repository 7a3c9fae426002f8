"""The text-record path: files written by one stage and parsed by the next.

These reproduce the line jobs' data flow on Spark: the incident extract is a
';'-delimited file with a header, and each reader parses its own input by
position. What a stage hands to the next stays a typed frame. Every write goes to a fresh path under the session's shared
scratch directory (``spark.checkpoint.dir``), so a lost executor only
re-runs tasks and the re-read never depends on a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schema as S
from blotter.functions import line_field, null_to_empty, strip_whitespace, to_bigint
from blotter.operators import (
    arrest_rate_exact,
    carried_forward,
    clean_district,
    count_by_type,
    dirty_row_filter,
    order_by_district_count,
    range_sort,
    tagged_union_join,
)
from blotter.operators.joins import ENTRY, FACT
from blotter.session import kept_path
from blotter.sinks import export_single_file, without_descriptions, write_delimited
from blotter.sinks import write_extract as write_extract_file
from blotter.sources import (
    drop_header,
    read_extract,
    read_incidents,
    read_lines,
    read_parsed,
    read_routed,
    split_damaged,
    split_key_value,
    split_positional,
)


def write_extract(spark: SparkSession, incidents: DataFrame, with_description: bool = True) -> str:
    """Write the extract (header, ';') to a fresh scratch path; return it."""
    path = kept_path(spark, "extract")
    write_extract_file(incidents, path, with_description)
    return path


def csv_roundtrip(spark: SparkSession, incidents: DataFrame) -> DataFrame:
    """Write the extract and read it back with the fixed schema."""
    path = write_extract(spark, incidents)
    return read_incidents(spark, path).select(*S.CANONICAL_INCIDENT_COLUMNS)


def drop_columns(spark: SparkSession, extract_path: str) -> DataFrame:
    """Preparation job: read the extract, drop the descriptive columns, write
    the 20-column extract with header; return it read back."""
    path = kept_path(spark, "extract-nodesc")
    write_delimited(without_descriptions(read_extract(spark, extract_path)), path, header=True)
    return read_incidents(spark, path, with_description=False).select("iucr", "arrest", "district", "year")


def whole_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of an extract that have every field of its header, each as one
    text of its non-null fields. All columns are read, so ``DROPMALFORMED``
    checks all of them."""
    rows = read_extract(spark, paths)
    return rows.select(F.concat_ws("|", *[rows[f"`{c}`"] for c in rows.columns]).alias("line"))


def single_file_readback(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Write ``counts`` over an earlier result as one ';' file without a
    header; its lines, and whether each is in the first part file."""
    path = kept_path(spark, "single-file")
    write_delimited(counts.select("cnt"), path, header=True)
    export_single_file(counts, path)
    return read_lines(spark, path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").startswith("part-00000-").alias("in_first_file")
    )


def delimited_line_parse(spark: SparkSession, extract_path: str | list[str], keep_short: bool = False) -> DataFrame:
    """Rate job's reader: year, code and arrest by position; header dropped by
    the year field; year parsed to a number. Short lines are dropped, or have
    nulls with ``keep_short``."""
    lines = read_lines(spark, extract_path)
    pos = S.INCIDENT_POSITIONS
    parsed = split_positional(
        lines, {"year": pos["year"], "iucr": pos["iucr"], "arrest": pos["arrest"]}, keep_short=keep_short
    )
    parsed = drop_header(parsed, "year", "Year")
    return parsed.select(to_bigint("year").alias("year"), "iucr", "arrest")


def type_count_lines_clean(spark: SparkSession, extract_path: str | list[str]) -> DataFrame:
    """Count job on raw lines of the extract: positional fields, dirty-row
    filters (which also remove the header, whose district field reads
    ``District``), counts per ``(district, description, code)``,
    case-insensitive order."""
    lines = read_lines(spark, extract_path)
    pos = S.INCIDENT_POSITIONS
    parsed = split_positional(
        lines, {"iucr": pos["iucr"], "district": pos["district"], "description": pos["description"]}
    )
    counted = count_by_type(dirty_row_filter(parsed, description="description"))
    return order_by_district_count(
        counted, case_insensitive=True, tiebreak=("iucr", "description")
    ).select("district", "description", "cnt")


def line_code_counts(spark: SparkSession, extract_nodesc_path: str | list[str]) -> DataFrame:
    """First stage of the line join job: counts per ``(code, district)`` from
    the raw lines of the extract without descriptions (district at field 9),
    dirty districts and the header removed."""
    lines = read_lines(spark, extract_nodesc_path)
    pos = S.INCIDENT_NO_DESCRIPTION_POSITIONS
    parsed = split_positional(lines, {"iucr": pos["iucr"], "district": pos["district"]})
    return count_by_type(dirty_row_filter(parsed), with_description=False)


def arrest_rate_lines(spark: SparkSession, extract_path: str | list[str], partitions: int) -> DataFrame:
    """The rate job's line form: year, code and arrest by position, header
    dropped by the year field, any-case unrounded rate per ``(year, code)``,
    year parsed to a number, total order over ``partitions`` range
    partitions."""
    lines = read_lines(spark, extract_path)
    pos = S.INCIDENT_POSITIONS
    parsed = split_positional(lines, {"year": pos["year"], "iucr": pos["iucr"], "arrest": pos["arrest"]})
    rates = arrest_rate_exact(drop_header(parsed, "year", "Year"))
    out = rates.select(to_bigint("year").alias("year"), "iucr", "pct")
    return range_sort(out, partitions, ("year", "iucr"))


def count_lines(counts: DataFrame) -> DataFrame:
    """Counts per ``(code, district)`` as text records ``district;code__<TAB>cnt``."""
    return counts.select(
        F.format_string("%s;%s__\t%d", null_to_empty("district"), null_to_empty("iucr"), F.col("cnt")).alias("value")
    )


def key_value_line_parse(counts: DataFrame) -> DataFrame:
    """Count records as key/value lines split at the first ';'."""
    return split_key_value(count_lines(counts))


def parse_code_records(kv: DataFrame) -> DataFrame:
    """Lookup lines split at the first ';': code, then the secondary
    description as field 1 of the rest; the header line is skipped."""
    rest = F.split(F.col("v"), ";", -1)
    parsed = kv.select(
        strip_whitespace("k").alias("iucr"),
        F.col("k").alias("_raw_key"),
        line_field(rest, 1).alias("description"),
    )
    return drop_header(parsed, "_raw_key", "IUCR", how="equals").drop("_raw_key")


def tagged_cogroup_join(spark: SparkSession, counts: DataFrame, codes_path: str) -> DataFrame:
    """Join of the counts and the lookup lines, on the code.

    The line job writes its counts as text records, tags each record with its
    origin, groups both by code and pairs the two lists. Here the counts keep
    their types (code and district free of whitespace, as the record reader
    leaves them), the origin is the frame, and the pairing is a reduce-side
    sort-merge join with nothing buffered per key.
    """
    facts = counts.select(
        strip_whitespace(null_to_empty("district")).alias("district"), strip_whitespace("iucr").alias("iucr"), "cnt"
    )
    lookup = parse_code_records(split_key_value(read_lines(spark, codes_path)))
    joined = facts.join(lookup.hint("merge"), "iucr", "inner")
    return order_by_district_count(joined, case_insensitive=True, tiebreak=("iucr",)).select(
        "district", "description", "cnt"
    )


def tagged_union_counts(spark: SparkSession, counts: DataFrame, codes_path: str) -> DataFrame:
    """:func:`tagged_cogroup_join` by the line job's own data flow: one table of
    tagged records, one exchange by code, no join operator."""
    facts = counts.select(
        strip_whitespace(null_to_empty("district")).alias("district"), strip_whitespace("iucr").alias("iucr"), "cnt"
    )
    lookup = parse_code_records(split_key_value(read_lines(spark, codes_path)))
    joined = tagged_union_join(facts, lookup)
    return order_by_district_count(joined, case_insensitive=True, tiebreak=("iucr",)).select("district", "description", "cnt")


def one_scan_join(spark: SparkSession, extract_nodesc: str | list[str], codes_path: str) -> DataFrame:
    """The same question from one scan of both files: each line is parsed by the
    parser of its input, incidents are counted and equal lookup entries too
    (one partial aggregation for both), then :func:`carried_forward`."""
    pos = S.INCIDENT_NO_DESCRIPTION_POSITIONS
    lines = read_routed(spark, {"facts": extract_nodesc, "codes": codes_path})
    is_fact = F.col("input") == "facts"
    last = max(pos["iucr"], pos["district"])
    fact = F.split("value", ";", last + 2)
    entry = F.split("value", ";", -1)
    parsed = lines.select(
        F.when(is_fact, FACT).otherwise(ENTRY).alias("tag"),
        F.when(is_fact, line_field(fact, pos["iucr"])).otherwise(line_field(entry, 0)).alias("iucr"),
        F.when(is_fact, line_field(fact, pos["district"])).alias("district"),
        F.when(~is_fact, line_field(entry, 2)).alias("description"),
        F.when(is_fact, F.size(fact) > last).otherwise(F.col("value") != "").alias("whole"),
    )
    kept = parsed.where(
        F.col("whole") & F.when(F.col("tag") == FACT, clean_district()).otherwise(F.col("iucr") != "IUCR")
    )
    counted = kept.groupBy(
        "tag", strip_whitespace("iucr").alias("iucr"), strip_whitespace(null_to_empty("district")).alias("district"), "description"
    ).agg(F.count(F.lit(1)).alias("cnt"))
    joined = carried_forward(counted, "iucr", "description", times="cnt")
    return order_by_district_count(joined, case_insensitive=True, tiebreak=("iucr",)).select("district", "description", "cnt")


def damaged_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines that a strict ``DROPMALFORMED`` read of an extract drops."""
    return split_damaged(read_parsed(spark, paths, S.INCIDENT_HEADER))[1]


def whole_incidents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows that the same read keeps, each as one text of its non-null fields."""
    whole, _ = split_damaged(read_parsed(spark, paths, S.INCIDENT_HEADER))
    return whole.select(F.concat_ws("|", *[whole[f"`{c}`"] for c in whole.columns]).alias("line"))
