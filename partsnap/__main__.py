"""``python -m partsnap backup|audit TABLES``: the two scheduled jobs, on spark-submit's session."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import INCREMENTAL_GATES
from partsnap.functions.rows import SIDE
from partsnap.operators.diff import SIDES
from partsnap.operators.listing import RANK
from partsnap.plans import outcome as oc
from partsnap.plans.validate import batch_report, differing_rows
from partsnap.sources import catalog

# Statuses of a table whose backup or audit was not done.
UNDONE = {oc.FAILED, oc.SCHEMA_DRIFT, oc.MISSING_SOURCE, oc.MISSING_BACKUP, oc.NOT_PARTITIONED, oc.REFUSED}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="partsnap")
    jobs = p.add_subparsers(dest="job", required=True)
    for name in ("backup", "audit"):
        job = jobs.add_parser(name)
        job.add_argument("tables", help="comma-separated table names")
        job.add_argument("--database")
        job.add_argument("--suffix", default=catalog.DEFAULT_SUFFIX)
    backup, audit = jobs.choices["backup"], jobs.choices["audit"]
    backup.add_argument("--history", type=int, metavar="N", help="copy the N newest partitions instead of the newest one")
    backup.add_argument("--keep", type=int, default=3)
    backup.add_argument("--allow-empty", action="store_true", help="let --keep 0 empty the backups")
    backup.add_argument("--location-root", help="new backups are external tables below this folder")
    backup.add_argument("--gate", choices=INCREMENTAL_GATES, default=INCREMENTAL_GATES[0])
    backup.add_argument("--keys-as-text", action="store_true")
    audit.add_argument("--partition", help="one key value (tables with one partition key): totals and profile cover it")
    audit.add_argument("--last", type=int, metavar="N", help="the N newest partitions only, in the volume part")
    audit.add_argument("--side", choices=SIDES, default="both", help="which differences count")
    audit.add_argument("--show", type=int, metavar="N", help="print the first N differing rows of every partition and side")
    audit.add_argument("--store", help="table that keeps the parts of every run")
    for job in (backup, audit):
        job.add_argument("--parallelism", type=int, default=1)
    return p


def exit_code(job: str, statuses: Sequence[str]) -> int:
    """1 if a table was not done (failed, refused or missing); 2 if all audits ran and some found differences; else 0."""
    if set(statuses) & UNDONE:
        return 1
    return 2 if job == "audit" and "different" in statuses else 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one job, show its result rows; see :func:`exit_code`."""
    p = parser()
    a = p.parse_args(argv)
    if a.parallelism < 1:
        p.error("--parallelism must be at least 1")
    if a.job == "backup":
        try:
            policy = Policy(
                history_load=a.history is not None, load=3 if a.history is None else a.history, keep=a.keep, gate=a.gate, suffix=a.suffix,
                stringify_keys=a.keys_as_text, allow_empty=a.allow_empty, database=a.database, location_root=a.location_root,
            )
        except ValueError as error:
            p.error(str(error))
    elif (a.last is not None and a.last < 1) or (a.show is not None and a.show < 1):
        p.error("--last and --show must be at least 1")
    spark = spark or SparkSession.builder.appName(f"partsnap-{a.job}").getOrCreate()
    if a.job == "backup":
        result = run_batch(spark, a.tables, policy, a.parallelism)
    else:
        scope = dict(partition=a.partition, last_n=a.last, side=a.side)
        result = batch_report(spark, a.tables, a.suffix, a.database, **scope, store=a.store, parallelism=a.parallelism)["totals"]
    rows = result.collect()
    for r in rows:
        print(r.asDict())
        if a.job == "audit" and a.show and r["status"] in ("different", "schema_drift") and r["prod_rows"] is not None:
            for row in differing_rows(spark, r["table"], r["backup"], a.show, **scope).orderBy(SIDE, RANK).toLocalIterator():
                print("  ", row.asDict())
    return exit_code(a.job, [r["status"] for r in rows])


if __name__ == "__main__":
    raise SystemExit(main())
