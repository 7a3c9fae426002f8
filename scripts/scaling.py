"""How the headline plans grow with the data.

Usage: python scripts/scaling.py [sf_dir] [factor ...] [--csv]

Writes the prepared incident table replicated ``factor`` times (each row
repeated via ``explode(sequence(1, factor))``, no join) under the session's
scratch directory, then times the direct count, the left join and the rounded
arrest rate on it (median of 3 after a warm-up, ``noop`` sink). Prints one
line per factor.

``--csv`` instead writes the replicated table as the ';' extract and times
the file-to-file count jobs on it (quote-aware reader, and the line form on
raw lines), output to fresh scratch paths: the reference's own setting of a
CSV input.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from blotter.plans import compose as C  # noqa: E402
from blotter.plans import jobs  # noqa: E402
from blotter.sinks import write_extract  # noqa: E402
from blotter.session import build_session, scratch_path  # noqa: E402
from blotter.sources import tpch  # noqa: E402


def _time(df, runs=3):
    df.write.format("noop").mode("overwrite").save()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    factors = [int(a) for a in args if a.isdigit()] or [1, 4, 16]
    spark = build_session("local[8]", app_name="blotter-scaling", shuffle_partitions=8)
    base = tpch.incidents(spark, sf_dir)
    codes = tpch.shipped_codes(spark, sf_dir)
    if "--csv" in args:
        print(f"{'factor':>6s} {'rows':>12s} {'count job':>10s} {'count --lines':>14s}")
        for k in factors:
            path = scratch_path(spark, f"scaled-csv-{k}")
            rep = base.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(k)))).drop("_copy")
            write_extract(rep, path)
            times = []
            for lines in (False, True):
                jobs.count(spark, path, scratch_path(spark, "scaled-out"), clean=lines, lines=lines)
                samples = []
                for _ in range(3):
                    t0 = time.perf_counter()
                    jobs.count(spark, path, scratch_path(spark, "scaled-out"), clean=lines, lines=lines)
                    samples.append(time.perf_counter() - t0)
                times.append(statistics.median(samples))
            print(f"{k:>6d} {base.count() * k:>12,d} {times[0]:>10.2f} {times[1]:>14.2f}", flush=True)
        spark.stop()
        return
    print(f"{'factor':>6s} {'rows':>12s} {'count':>8s} {'left join':>10s} {'arrest %':>9s}")
    for k in factors:
        path = scratch_path(spark, f"scaled-{k}")
        rep = base.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(k)))).drop("_copy")
        rep.write.parquet(path)
        inc = spark.read.parquet(path)
        n = inc.count()
        t_count = _time(C.type_count_by_district(inc))
        t_join = _time(C.type_count_with_lookup(inc.select("iucr", "district"), codes))
        t_rate = _time(C.arrest_pct(inc))
        print(f"{k:>6d} {n:>12,d} {t_count:>8.2f} {t_join:>10.2f} {t_rate:>9.2f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
