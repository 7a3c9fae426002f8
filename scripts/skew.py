"""Hot-key experiment: one (code, district) holds a third of all incidents.

Usage: python scripts/skew.py [sf_dir] [event_log_dir]

Rewrites the prepared sf incident table so that every third row gets the
same code and district (written once, so the data is fixed), runs the direct
count, the left join and the rounded rate into the ``noop`` sink with the
event log on, and prints per stage the number of tasks, the records read from
the scan, and the largest and median number of shuffle records a single task
read. With partial aggregation the hot key reaches its reducer as at most
one row per map task.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from blotter.plans import compose as C  # noqa: E402
from blotter.session import build_session, scratch_path  # noqa: E402
from blotter.sources import tpch  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="blotter-skew-")
    spark = build_session(
        "local[8]",
        app_name="blotter-skew",
        shuffle_partitions=8,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    base = tpch.incidents(spark, sf_dir)
    hot = F.monotonically_increasing_id() % 3 == 0
    skewed = base.select(
        F.when(hot, F.lit("0001")).otherwise(F.col("iucr")).alias("iucr"),
        "primary_type",
        "description",
        "arrest",
        F.when(hot, F.lit("001")).otherwise(F.col("district")).alias("district"),
        "year",
    )
    path = scratch_path(spark, "skewed")
    skewed.write.parquet(path)
    inc = spark.read.parquet(path)
    n = inc.count()
    n_hot = inc.filter((F.col("iucr") == "0001") & (F.col("district") == "001")).count()
    codes = tpch.shipped_codes(spark, sf_dir)
    runs = {
        "count_direct": C.type_count_by_district(inc),
        "count_left_join": C.type_count_with_lookup(inc.select("iucr", "district"), codes),
        "arrest_pct": C.arrest_pct(inc),
    }
    for name, df in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    log = max(glob.glob(os.path.join(log_dir, "*")), key=os.path.getmtime)
    stage_group: dict[int, str] = {}
    per_stage = defaultdict(lambda: {"scan": 0, "shuffle_read": []})
    with open(log) as fh:
        for line in fh:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerTaskEnd":
                sid = ev.get("Stage ID")
                if stage_group.get(sid) not in runs:
                    continue
                m = ev.get("Task Metrics") or {}
                st = per_stage[(stage_group[sid], sid)]
                st["scan"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                st["shuffle_read"].append((m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
    print(f"incidents {n:,d}, hot (code 0001, district 001): {n_hot:,d}; event log {log}")
    print(f"{'query':18s} {'stage':>5s} {'tasks':>5s} {'scan recs':>10s} {'max shuffle read/task':>22s} {'median':>8s}")
    for (name, sid), st in sorted(per_stage.items(), key=lambda kv: kv[0][1]):
        reads = st["shuffle_read"]
        print(f"{name:18s} {sid:>5d} {len(reads):>5d} {st['scan']:>10,d} {max(reads):>22,d} "
              f"{int(statistics.median(reads)):>8,d}")


if __name__ == "__main__":
    main()
