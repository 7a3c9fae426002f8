"""Scalar column functions.

Each returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_WIDTH = 4


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c) -> Column:
    """Remove every whitespace character (tabs and spaces left by text stages)."""
    return F.regexp_replace(_col(c), r"\s", "")


def pad_code(c, width: int = CODE_WIDTH) -> Column:
    """Left-pad a short code with zeros.

    ``lpad`` truncates longer input, so only strings shorter than ``width``
    are padded; longer codes pass unchanged.
    """
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_code(c, width: int = CODE_WIDTH) -> Column:
    """Whitespace-free, zero-padded code, applied to both sides of a join."""
    return pad_code(strip_whitespace(c), width)


def arrest_flag(c, case_sensitive: bool = True) -> Column:
    """Text flag -> boolean: exact ``'true'``, or any letter case.

    A null flag yields null, which ``flag_as_int`` maps to 0 (not arrested).
    """
    c = _col(c)
    return (c == F.lit("true")) if case_sensitive else (F.lower(c) == F.lit("true"))


def flag_as_int(flag: Column) -> Column:
    """1 when the flag holds, else 0 (null counts as 0)."""
    return F.when(flag, F.lit(1)).otherwise(F.lit(0))


def null_to_empty(c) -> Column:
    """Null -> empty string, as a text-stage key would carry it."""
    return F.coalesce(_col(c), F.lit(""))


def to_bigint(c) -> Column:
    """Parse an integer; malformed text gives null instead of failing the task."""
    return _col(c).try_cast("bigint")


def line_field(fields: Column, i: int) -> Column:
    """Field ``i`` of a split line, null when the line is too short."""
    return F.get(fields, i)
