"""Write the final (post-AQE) physical plans of key queries to PLANS.md.

Usage: python scripts/dump_plans.py [sf_dir] [out_md]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.plans.catalog import HEADLINE, QUERIES  # noqa: E402
from blotter.session import build_session  # noqa: E402

EXTRA = (
    "type_count_by_district_csv", "type_count_mixed_headers", "tagged_cogroup_join", "tagged_union_join", "one_scan_join",
    "arrest_pct_range_sorted", "split_points_sample", "split_point_partitions", "natural_key_layout",
)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("local[8]", app_name="blotter-plans", shuffle_partitions=4)
    parts = [
        "# Final physical plans\n",
        f"Generated by `scripts/dump_plans.py` on `{os.path.basename(sf_dir)}` (local[8], "
        "4 shuffle partitions, AQE on), after running each query once, so the plans "
        "are AQE's final ones. Scan locations are the session's scratch directory.\n",
    ]
    for name in HEADLINE + EXTRA:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # runs this frame's own plan, so explain() shows the final AQE plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        text = "\n".join(
            line for line in buf.getvalue().splitlines() if line.strip()
        )
        parts.append(f"## {name}\n\n```\n{text}\n```\n")
    spark.stop()
    with open(out, "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main()
