"""Skew check: a third of all rows are one identical row; is any task handed the hot group?

Builds from ``lineitem`` a production side where every row with
``l_orderkey % 3 = 0`` is replaced by the same constant row, and a backup
without that row, so the hot row is reported about 200k times (sf0.1).
Runs the row diff with Spark's event log in a scratch folder and prints, per
stage, the records read by the busiest task against the stage total.

Usage: python tests/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="partsnap-skew-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from pyspark.sql import functions as F

    from partsnap.fixtures import table
    from partsnap.operators.diff import row_diff
    from partsnap.operators.fingerprint import partition_fingerprints
    from partsnap.operators.profile import distinct_profile
    from partsnap.operators.volume import volume_by_partition

    li = table(spark, sf_dir, "lineitem")
    cols = li.columns
    constants = ["-1L", "-1L", "-1L", "-1", "0D", "0D", "0D", "0D", "'H'", "'H'", "timestamp_ntz'2000-01-01 00:00:00'"]
    prod = li.selectExpr(*[f"if(l_orderkey % 3 = 0, {k}, {c}) as {c}" for c, k in zip(cols, constants)])
    bkup = prod.where("l_orderkey <> -1")
    total = prod.count()
    hot_rows = prod.where("l_orderkey = -1").count()
    keyed_p = prod.selectExpr("*", "format_string('%04d-%02d', year(l_shipdate), month(l_shipdate)) as pd")
    keyed_b = bkup.selectExpr("*", "format_string('%04d-%02d', year(l_shipdate), month(l_shipdate)) as pd")
    diff = row_diff(prod, bkup, "prod")
    runs = {
        "row_diff": lambda: diff.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect(),
        "volume_by_partition": lambda: volume_by_partition(keyed_p, keyed_b, ["pd"]).collect(),
        "distinct_profile": lambda: distinct_profile(prod, bkup).collect(),
        "partition_fingerprints": lambda: partition_fingerprints(keyed_p, keyed_b, ["pd"]).collect(),
    }
    results = {}
    for name, run in runs.items():
        spark.sparkContext.setJobDescription(name)
        results[name] = run()
        spark.sparkContext.setJobDescription(None)
    per_task_out = [r["n"] for r in results["row_diff"]]
    out = sum(per_task_out)
    spark.stop()

    events = []
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isfile(path):
            with open(path) as fh:
                events += [json.loads(line) for line in fh]
    stage_of = {}
    for ev in events:
        if ev.get("Event") == "SparkListenerJobStart":
            desc = (ev.get("Properties") or {}).get("spark.job.description")
            if desc in runs:
                for sid in ev.get("Stage IDs", []):
                    stage_of[sid] = desc
    records = defaultdict(list)
    for ev in events:
        if ev.get("Event") == "SparkListenerTaskEnd" and ev.get("Stage ID") in stage_of:
            m = ev.get("Task Metrics") or {}
            read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            if read:
                records[(stage_of[ev["Stage ID"]], ev["Stage ID"])].append(read)
    print(f"rows {total}, hot copies {hot_rows} ({hot_rows / total:.0%}), hot row reported {out} times")
    for (name, stage), per_task in sorted(records.items(), key=lambda kv: kv[0][1]):
        print(f"{name:24s} stage {stage:3d}: tasks {len(per_task)}, shuffle records {sum(per_task):7d}, "
              f"busiest task {max(per_task) / sum(per_task):.0%}")
    print(f"row_diff rows emitted per output partition: {sorted(per_task_out, reverse=True)} "
          f"(busiest {max(per_task_out) / out:.0%})")


if __name__ == "__main__":
    main()
