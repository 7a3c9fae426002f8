"""Dirty-row filters of the line jobs, made explicit and null-safe.

In the text jobs an empty district is the empty string and passes every
test; in a DataFrame it is null, and a bare ``NOT IN`` / ``NOT contains``
would drop it. Every negated test therefore keeps nulls explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# District texts that mark a shifted or header row, and the
# description fragment of a damaged quoted field.
DIRTY_DISTRICTS = ("true", "false", "District")
DIRTY_DESCRIPTION = '"THEFT BY LESSEE'


def clean_district(district: str = "district") -> Column:
    """True for a usable district: null, or not a marker and without spaces."""
    d = F.col(district)
    return d.isNull() | (~d.isin(*DIRTY_DISTRICTS) & ~d.contains(" "))


def clean_description(description: str = "description") -> Column:
    """True unless the description holds the damaged quoted fragment."""
    d = F.col(description)
    return d.isNull() | ~d.contains(DIRTY_DESCRIPTION)


def dirty_row_filter(
    df: DataFrame, district: str = "district", description: str | None = None
) -> DataFrame:
    """Drop rows with a dirty district and, if ``description`` is given, a
    damaged description. A plain narrow filter: Catalyst pushes it into the
    scan where the source allows."""
    cond = clean_district(district)
    if description is not None:
        cond = cond & clean_description(description)
    return df.filter(cond)
