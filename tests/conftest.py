from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from blotter import schema as S  # noqa: E402
from blotter.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Key columns of the 11 fixture incidents: IUCR, Description (raw text as it
# stands in the file), Arrest, District, Year.
FIXTURE_ROWS = [
    ("0110", "FIRST DEGREE MURDER", "true", "001", "2001"),
    ("0110", "FIRST DEGREE MURDER", "false", "001", "2001"),
    ("0460", "SIMPLE", "false", "001", "2001"),
    ("0460", "SIMPLE", "true", "001", "2002"),
    ("0460", "SIMPLE", "True", "002", "2002"),
    ("0460", "SIMPLE BATTERY", "false", "001", "2002"),
    ("0820", "$500 AND UNDER", "false", "", "2002"),
    ("9999", "UNKNOWN CODE", "false", "002", "2001"),
    ("0486", '"A; B"', "true", "002", "2001"),
    ("0820", "$500 AND UNDER", "false", " 03", "2001"),
    ("0820", '"THEFT BY LESSEE, NON-VEH"', "false", "001", "2001"),
]

CODES_TEXT = (
    "IUCR;Primary Description;Secondary Description\n"
    "0110;HOMICIDE;FIRST DEGREE MURDER\n"
    "0460;BATTERY;SIMPLE\n"
    "0820;THEFT;$500 AND UNDER\n"
    "486;BATTERY;DOMESTIC\n"
)


def local(path: str) -> str:
    """Local file-system path of a ``file:`` URI from the scratch directory."""
    return path[len("file:"):] if path.startswith("file:") else path


def fixture_line(n: int, row, with_description: bool = True) -> str:
    iucr, desc, arrest, district, year = row
    fields = []
    for i, name in enumerate(S.INCIDENT_HEADER):
        if i == 0:
            v = str(n)
        elif name == "IUCR":
            v = iucr
        elif name == "Primary Type":
            v = "P"
        elif name == "Description":
            v = desc
        elif name == "Arrest":
            v = arrest
        elif name == "Domestic":
            v = "false"
        elif name == "District":
            v = district
        elif name == "Year":
            v = year
        else:
            v = f"x{i}"
        if with_description or name not in S.DESCRIPTIVE_COLUMNS:
            fields.append(v)
    return ";".join(fields)


def incidents_text(with_description: bool = True) -> str:
    header = [h for h in S.INCIDENT_HEADER if with_description or h not in S.DESCRIPTIVE_COLUMNS]
    lines = [";".join(header)]
    lines += [fixture_line(n, r, with_description) for n, r in enumerate(FIXTURE_ROWS, start=1)]
    return "\n".join(lines) + "\n"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="blotter-tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_files(tmp_path_factory):
    """The fixture extract and lookup written as literal text (not with the
    CSV writer, which would alter surrounding whitespace)."""
    d = tmp_path_factory.mktemp("fixtures")
    paths = {
        "incidents": d / "crimes.csv",
        "codes": d / "iucr.csv",
    }
    paths["incidents"].write_text(incidents_text())
    paths["codes"].write_text(CODES_TEXT)
    return {k: str(v) for k, v in paths.items()}
