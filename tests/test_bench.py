"""bench.py prints exactly one JSON line with the driver's fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT, SMOKE_DIR


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="driver tables missing")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMOKE_DIR, BENCH_CPUS="2", BENCH_RUNS="1")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=900,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert out["value"] == pytest.approx(sum(out["queries"].values()), abs=1e-3)
    assert set(out["baseline_rows"].values()) <= set(out["queries"])
    assert all(v > 0 for v in out["queries"].values())
