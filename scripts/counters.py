"""Job counters for the headline queries, from Spark's event log.

Usage: python scripts/counters.py [sf_dir] [event_log_dir]

Runs each headline query once into the ``noop`` sink with the event log
enabled (written to ``event_log_dir``, default a fresh ``mktemp`` folder) and
prints, per query, the records read by the scans, the records and bytes
written to shuffles, and the result rows -- the counterpart of the map input /
combine output / shuffle bytes counters the reference published.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.plans.catalog import HEADLINE, QUERIES  # noqa: E402
from blotter.session import build_session  # noqa: E402
from blotter.sources import tpch  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="blotter-events-")
    spark = build_session(
        "local[8]",
        app_name="blotter-counters",
        shuffle_partitions=4,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    rows = {}
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)  # jobs run while building the plan
        df = QUERIES[name](spark, sf_dir)
        spark.sparkContext.setJobGroup(f"rows:{name}", "row count")
        rows[name] = df.count()
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    log = max(glob.glob(os.path.join(log_dir, "*")), key=os.path.getmtime)
    stage_group = {}
    stats = defaultdict(lambda: defaultdict(int))
    with open(log) as fh:
        for line in fh:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                stats[group]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                group = stage_group.get((ev.get("Stage Info") or {}).get("Stage ID"))
                if group is not None:
                    stats[group]["stages"] += 1
            elif kind == "SparkListenerTaskEnd":
                group = stage_group.get(ev.get("Stage ID"))
                if group is None:
                    continue
                m = ev.get("Task Metrics") or {}
                s = stats[group]
                s["input_records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                sw = m.get("Shuffle Write Metrics") or {}
                s["shuffle_records"] += sw.get("Shuffle Records Written", 0)
                s["shuffle_bytes"] += sw.get("Shuffle Bytes Written", 0)
                s["tasks"] += 1
    print(f"event log: {log}")
    print(f"{'query':30s} {'jobs':>4s} {'stages':>6s} {'scan records':>13s} {'shuffle recs':>13s} "
          f"{'shuffle bytes':>14s} {'result rows':>12s}")
    for name in HEADLINE:
        s = stats[name]
        print(f"{name:30s} {s['jobs']:>4d} {s['stages']:>6d} {s['input_records']:>13,d} "
              f"{s['shuffle_records']:>13,d} {s['shuffle_bytes']:>14,d} {rows[name]:>12,d}")


if __name__ == "__main__":
    main()
