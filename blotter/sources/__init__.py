"""Readers: delimited files, text lines and the driver-table incident view."""

from blotter.sources.delimited import (
    MissingColumnError,
    MissingInputError,
    canonical,
    checked_read,
    incident_columns,
    read_codes,
    read_delimited,
    read_extract,
    read_incidents,
    read_parsed,
    split_damaged,
)
from blotter.sources.lines import drop_header, read_lines, read_routed, split_key_value, split_positional

__all__ = [
    "MissingColumnError",
    "MissingInputError",
    "canonical",
    "checked_read",
    "incident_columns",
    "read_codes",
    "read_delimited",
    "read_extract",
    "read_incidents",
    "read_parsed",
    "split_damaged",
    "drop_header",
    "read_lines",
    "read_routed",
    "split_key_value",
    "split_positional",
]
