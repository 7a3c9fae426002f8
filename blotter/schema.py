"""Schemas of the incident extract, the code lookup and the results.

All source columns are strings: codes and districts carry leading zeros that
type inference would destroy, and flags arrive as text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The header of the public crime extract the jobs read
# (22 columns, ';'-separated).
INCIDENT_HEADER = (
    "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
    "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
    "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year",
    "Updated On", "Latitude", "Longitude", "Location",
)

# The descriptive columns removed by the preparation job.
DESCRIPTIVE_COLUMNS = ("Primary Type", "Description")

# Header of the code lookup file.
CODE_HEADER = ("IUCR", "Primary Description", "Secondary Description")

# Source header name -> canonical column name used by every operator.
CANONICAL = {
    "IUCR": "iucr",
    "Primary Type": "primary_type",
    "Description": "description",
    "Arrest": "arrest",
    "District": "district",
    "Year": "year",
    "Primary Description": "primary_description",
    "Secondary Description": "secondary_description",
}


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


INCIDENT_SCHEMA = _strings(INCIDENT_HEADER)
INCIDENT_NO_DESCRIPTION_SCHEMA = _strings(
    [c for c in INCIDENT_HEADER if c not in DESCRIPTIVE_COLUMNS]
)
CODE_SCHEMA = _strings(CODE_HEADER)


def positions(header) -> dict[str, int]:
    """0-based position of each canonical column in a delimited line."""
    return {CANONICAL[h]: i for i, h in enumerate(header) if h in CANONICAL}


INCIDENT_POSITIONS = positions(INCIDENT_HEADER)
INCIDENT_NO_DESCRIPTION_POSITIONS = positions(INCIDENT_NO_DESCRIPTION_SCHEMA.names)

# The canonical incident table the operators consume.
CANONICAL_INCIDENT_COLUMNS = ("iucr", "primary_type", "description", "arrest", "district", "year")
CANONICAL_INCIDENT_SCHEMA = _strings(CANONICAL_INCIDENT_COLUMNS)
