"""Retention: keep the ``keep`` newest backup partitions, drop the others.

The listing comes from the catalog, so partitions without rows are counted
and dropped like the rest.  The eviction list is written to the shared
folder first and the drops are driven from what was written; drops are
``IF EXISTS``, so a rerun after a crash finishes the job without error.
Evicted partitions lose their files too, for external backups as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from partsnap.plans import ledger
from partsnap.plans import outcome as oc
from partsnap.sinks import tables
from partsnap.sources import catalog
from partsnap.sources.partitions import beyond, catalog_listing


def plan_eviction(spark: SparkSession, backup: str, keep: int, source: str | None = None) -> DataFrame:
    """Key tuples of ``backup`` beyond its ``keep`` newest partitions.

    With ``source``, keys that the backup keeps as text are ordered by their types there.
    """
    keys = catalog.partition_columns(spark, backup)
    like = spark.table(source) if source and catalog.exists(spark, source) else None
    if like is not None and not set(keys) <= set(like.columns):
        like = None
    return beyond(catalog_listing(spark, backup), keys, keep, like)


def apply_eviction(
    spark: SparkSession,
    backup: str,
    keep: int = 3,
    allow_empty: bool = False,
    run_id: str | None = None,
    source: str | None = None,
) -> oc.Outcome:
    """Drop every partition of ``backup`` beyond the ``keep`` newest.

    ``keep=0`` would empty the backup and is refused unless ``allow_empty``.
    """
    if keep < 0:
        raise ValueError("keep must not be negative")
    if keep == 0 and not allow_empty:
        return oc.Outcome(backup, backup, "retention", oc.REFUSED, detail="keep=0 empties the backup")
    if not catalog.exists(spark, backup):
        return oc.Outcome(backup, backup, "retention", oc.MISSING_BACKUP)
    keys = catalog.partition_columns(spark, backup)
    if not keys:
        return oc.Outcome(backup, backup, "retention", oc.NOT_PARTITIONED)
    path = tables.manifest_path(spark, backup, run_id or uuid.uuid4().hex)
    tables.write_manifest(plan_eviction(spark, backup, keep, source), path)
    evict = spark.read.parquet(path).collect()
    if not evict:
        return oc.Outcome(backup, backup, "retention", oc.NOTHING_TO_EVICT, detail=path)
    tables.evict_partitions(spark, backup, keys, evict)
    ledger.forget(spark, backup, keys, evict)
    return oc.Outcome(backup, backup, "retention", oc.EVICTED, oc.key_text(keys, evict), detail=path)
