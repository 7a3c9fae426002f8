"""Column expressions shared by the operators (all JVM-side built-ins)."""

from blotter.functions.columns import (
    arrest_flag,
    flag_as_int,
    null_to_empty,
    pad_code,
    normalize_code,
    strip_whitespace,
    to_bigint,
    line_field,
)

__all__ = [
    "arrest_flag",
    "flag_as_int",
    "null_to_empty",
    "pad_code",
    "normalize_code",
    "strip_whitespace",
    "to_bigint",
    "line_field",
]
