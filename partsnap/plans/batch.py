"""Run the backup policy over a list of tables; one result row per table and action."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

from partsnap.plans import outcome as oc
from partsnap.plans.load import INCREMENTAL_GATES, history_load, incremental_load, snapshot_unpartitioned
from partsnap.plans.retention import apply_eviction
from partsnap.sources import catalog


@dataclass(frozen=True)
class Policy:
    """What to do with each table.

    ``history_load=True`` copies the ``load`` newest partitions; otherwise the
    newest partition is copied behind ``gate`` and the backup is trimmed to
    ``keep`` partitions (``keep=0`` loads nothing and empties the backup, and
    needs ``allow_empty``).  Unpartitioned tables are snapshotted whole.
    New backups are managed tables, or external ones under ``location_root``.
    """

    history_load: bool = False
    load: int = 3
    keep: int = 3
    gate: str = "same_key_count"
    suffix: str = catalog.DEFAULT_SUFFIX
    stringify_keys: bool = False
    allow_empty: bool = False
    database: str | None = None
    location_root: str | None = None

    def __post_init__(self) -> None:
        # Checked before any table is touched, not halfway through a batch.
        if self.gate not in INCREMENTAL_GATES:
            raise ValueError(f"gate must be one of {INCREMENTAL_GATES}, got {self.gate!r}")
        if self.load < 1 or self.keep < 0:
            raise ValueError("load must be at least 1 and keep at least 0")


def table_names(tables: str | Sequence[str]) -> list[str]:
    """A comma-separated string or a list, stripped, blanks dropped."""
    items = tables.split(",") if isinstance(tables, str) else list(tables)
    return [t.strip() for t in items if t and t.strip()]


def run_table(spark: SparkSession, name: str, policy: Policy) -> list[oc.Outcome]:
    source = catalog.qualified(name, policy.database)
    backup = catalog.backup_name(source, policy.suffix)
    partitioned = catalog.is_partitioned(spark, source)
    if partitioned is None:
        return [oc.Outcome(source, backup, "check", oc.MISSING_SOURCE)]
    if not partitioned:
        return [snapshot_unpartitioned(spark, source, backup, location_root=policy.location_root)]
    if policy.history_load:
        return [history_load(spark, source, policy.load, backup, stringify_keys=policy.stringify_keys,
                             location_root=policy.location_root, fingerprints=policy.gate == "same_key_content")]
    done = []
    if policy.keep != 0:
        done.append(incremental_load(spark, source, backup, policy.gate, stringify_keys=policy.stringify_keys,
                                     location_root=policy.location_root))
    if done and done[0].status == oc.SCHEMA_DRIFT:
        return done  # a backup that cannot be refreshed keeps what it has
    done.append(apply_eviction(spark, backup, policy.keep, allow_empty=policy.allow_empty, source=source))
    return done


def run_batch(
    spark: SparkSession,
    tables: str | Sequence[str],
    policy: Policy = Policy(),
    parallelism: int = 1,
) -> DataFrame:
    """Apply ``policy`` to each table; returns the outcomes as a DataFrame, in table order.

    Tables are independent (each writes only its own backup), so with
    ``parallelism > 1`` up to that many tables are worked on at once: each
    thread submits its own Spark jobs and the scheduler runs them side by
    side, so a small table no longer waits for a large one and the cluster
    is not left idle between one table's stages.  Set
    ``spark.scheduler.mode=FAIR`` to share executors evenly between them.
    """
    if parallelism < 1:
        raise ValueError("parallelism must be at least 1")
    names = table_names(tables)
    sc = spark.sparkContext

    def one(name: str) -> list[oc.Outcome]:
        sc.setLocalProperty("spark.job.description", f"partsnap backup {name}")
        try:
            return run_table(spark, name, policy)
        except Exception as error:  # the other tables go on; the row says what happened
            source = catalog.qualified(name, policy.database)
            return [oc.Outcome(source, catalog.backup_name(source, policy.suffix), "backup", oc.FAILED, detail=str(error)[:1000])]
        finally:
            sc.setLocalProperty("spark.job.description", None)

    if parallelism == 1 or len(names) < 2:
        per_table = [one(n) for n in names]
    else:
        # A table named more than once (catalog names ignore case) runs its turns in
        # order in one worker, so no two threads ever write the same backup.
        turns: dict[str, list[int]] = {}
        for i, n in enumerate(names):
            turns.setdefault(n.lower(), []).append(i)
        per_table = [[] for _ in names]
        for done in side_by_side(spark, lambda positions: [(i, one(names[i])) for i in positions], turns.values(), parallelism):
            for i, outcomes in done:
                per_table[i] = outcomes
    return oc.to_frame(spark, [o for done in per_table for o in done])


def side_by_side(spark: SparkSession, work: Callable, items: Iterable, parallelism: int) -> list:
    """``work`` of each item, up to ``parallelism`` at once, in the order of the items.

    Each worker carries its own copy of this thread's Spark local properties
    (scheduler pool, job group), taken now, so it runs where the caller would.
    """
    items = list(items)
    if parallelism == 1 or len(items) < 2:
        return [work(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(functools.partial(work, x))) for x in items]
        return [f.result() for f in futures]
