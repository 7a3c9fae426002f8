from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows and a clashing column."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "src1", 3.5),
        (2, None, None, None),
        (3, "", "src1", 1.0),
        (4, " \t\n\x0b ", "src2", None),
        (None, "alpha beta gamma delta epsilon zeta", "src2", 2.0),
        (5, "word " * 30000, "src3", 2.0),
        (6, "ünïcode   wörd x 日本語 text", None, 0.0),
        (6, "ünïcode   wörd x 日本語 text", None, 0.0),
        (7, "same line here\nsame line here\n\nsame line here", "src3", 0.0),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, rate double")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string, lang string, n_chars bigint")
