"""Write PLANS.md: the physical plan outline of every registered query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def outline(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    lines = [ln for ln in tree.splitlines() if ln.strip() and not ln.startswith("==")]
    return "\n".join(lines)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from partsnap.plans.registry import QUERIES

    print("# Physical plans of the registered queries\n")
    print("Generated by `python tests/plan_report.py` (Spark 4.1, AQE on, before execution, so")
    print("`AdaptiveSparkPlan isFinalPlan=false`).  `Exchange` = shuffle; `HashAggregate` pairs")
    print("around an `Exchange` = partial (map-side) then final aggregation.  Plans over the")
    print("derived fixture views filter on computed keys; on a partitioned table the same")
    print("literal key filters appear as `PartitionFilters`.\n")
    for name, build in sorted(QUERIES.items()):
        df = build(spark, sf_dir)
        plan = outline(df)
        shuffles = plan.count("Exchange") - plan.count("BroadcastExchange")
        print(f"## {name}\n\nshuffles: {shuffles}\n\n```\n{plan}\n```\n")


if __name__ == "__main__":
    main()
