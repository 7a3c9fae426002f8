"""The entry module without the training-data part."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(blocked: str) -> tuple[int, str]:
    code = (
        "import sys\n"
        f"sys.modules[{blocked!r}] = None\n"
        "import __spark_entry__ as e\n"
        "from blotter.plans.catalog import QUERIES\n"
        "assert set(QUERIES) <= set(e.queries())\n"
        "print(len(e.queries()) - len(QUERIES), e.LLM_ABSENT)\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, why = out.stdout.strip().split(" ", 1)
    return int(n), why


def test_a_missing_package_leaves_the_other_queries():
    for blocked in ("xxhash", "corpus_pipeline", "blotter.llm"):
        n, why = _names(blocked)
        assert n == 0 and why != "None"
