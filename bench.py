"""Time the headline query variants and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``),
``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 5).

Timed: the DataFrame-form variants over the incident view, which every run
derives from ``lineitem`` and ``part`` (``HEADLINE``), the reference's
DataFrame jobs on the ';' extract files (``CSV_FORMS``) and the line-form jobs
(``LINE_FORMS``). A first call of each query is timed as ``cold``: it includes
compiling and, for the first query that reads text files, writing them, the
counterpart of the extract that the reference's jobs start from; that part is
also given alone as ``text_files_sec``. Then come ``BENCH_RUNS`` timed runs into
Spark's ``noop`` sink, which executes the whole plan (scan, derivation,
aggregation, join, sort) without collecting rows to the driver. The reported
value is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blotter.plans.catalog import BASELINE_ROWS, CSV_FORMS, HEADLINE, LINE_FORMS, QUERIES  # noqa: E402
from blotter.session import build_session  # noqa: E402
from blotter.sources import tpch  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="blotter-bench",
        # AQE coalesces the shuffle partitions by their measured sizes.
        extra={"spark.driver.memory": "8g"},
    )
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    timed = HEADLINE + CSV_FORMS + LINE_FORMS
    t0 = time.perf_counter()
    tpch.prepare_text(spark, sf_dir)
    text_files_sec = round(time.perf_counter() - t0, 4)
    cold: dict[str, float] = {}
    for name in timed:
        t0 = time.perf_counter()
        _run(QUERIES[name](spark, sf_dir))
        cold[name] = round(time.perf_counter() - t0, 4)
        rows[name] = QUERIES[name](spark, sf_dir).count()
    for name in timed:
        build = QUERIES[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            _run(build(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 4)
    tpch.release(spark)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "rows": rows,
                "forms": {"dataframe": list(HEADLINE), "csv": list(CSV_FORMS), "lines": list(LINE_FORMS)},
                "baseline_rows": BASELINE_ROWS,
                "cold": cold,
                "text_files_sec": text_files_sec,
                "runs": runs,
                "cpus": cpus,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
