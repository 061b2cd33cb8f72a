"""Backup loads: history (n newest partitions), incremental (newest, gated), unpartitioned.

Each job looks at catalog metadata first (existence, partition columns, the
partition listing), brings at most ``n`` key tuples to the driver, and then
runs one Spark write whose source scan is pruned to those partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from partsnap.operators import gates
from partsnap.operators.slices import rows_of
from partsnap.plans import journal, ledger
from partsnap.plans import outcome as oc
from partsnap.sinks import tables
from partsnap.sources import catalog
from partsnap.sources.partitions import catalog_listing, newest_keys, typed_like


# Gates an incremental load can run behind (see partsnap.operators.gates).
INCREMENTAL_GATES = ("same_key_count", "same_key_content", "latest_count")


def backup_location(backup: str, location_root: str | None) -> str | None:
    """``{root}/{backup name}`` for an external backup; None keeps it managed.

    External backups keep their files where the root says (the original
    tool's layout); retention still deletes the files of what it evicts.
    """
    return f"{location_root.rstrip('/')}/{backup.replace('.', '/')}" if location_root else None


def _partitioned_source(spark: SparkSession, source: str, backup: str, action: str):
    """(keys, None) for a usable partitioned source, else (None, Outcome)."""
    if not catalog.exists(spark, source):
        return None, oc.Outcome(source, backup, action, oc.MISSING_SOURCE)
    keys = catalog.partition_columns(spark, source)
    if not keys:
        return None, oc.Outcome(source, backup, action, oc.NOT_PARTITIONED)
    return keys, None


def _label(load: journal.Load) -> str:
    return ", ".join(oc.key_text(load.keys, load.chosen)) if load.keys else "the whole table"


def _finished(spark: SparkSession, source: str, backup: str, action: str):
    """(what was made up for, None), or (None, Outcome) if an unfinished load is refused now."""
    try:
        return journal.finish_open(spark, backup, _label), None
    except tables.SchemaDrift as drift:
        return None, oc.Outcome(source, backup, action, oc.SCHEMA_DRIFT, detail=f"an unfinished load is refused: {drift}")


def _detail(*parts: str) -> str:
    return "; ".join(p for p in parts if p)


def history_load(
    spark: SparkSession,
    source: str,
    n: int = 3,
    backup: str | None = None,
    suffix: str = catalog.DEFAULT_SUFFIX,
    stringify_keys: bool = False,
    location_root: str | None = None,
    fingerprints: bool = False,
) -> oc.Outcome:
    """Copy the ``n`` newest partitions of ``source`` into the backup.

    All partitions are copied when fewer than ``n`` exist.  Each copied
    partition replaces the backup partition of the same key; other backup
    partitions are left alone.  Loads that were lost on the way are done over
    first (:mod:`partsnap.plans.journal`), here and in the other loads.
    ``fingerprints`` keeps those of the loaded partitions (:mod:`partsnap.plans.ledger`).
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    backup = backup or catalog.backup_name(source, suffix)
    keys, done = _partitioned_source(spark, source, backup, "history_load")
    if done:
        return done
    made_up, refused = _finished(spark, source, backup, "history_load")
    if refused:
        return refused
    chosen = newest_keys(catalog_listing(spark, source), keys, n)
    if not chosen:
        return oc.Outcome(source, backup, "history_load", oc.EMPTY_SOURCE, detail=made_up)
    load = journal.Load(source, backup, keys, chosen, stringify_keys, backup_location(backup, location_root))
    try:
        journal.run(spark, load)
    except tables.SchemaDrift as drift:
        return oc.Outcome(source, backup, "history_load", oc.SCHEMA_DRIFT, oc.key_text(keys, chosen), detail=str(drift))
    if fingerprints:
        ledger.record(spark, source, backup, keys, chosen)
    return oc.Outcome(source, backup, "history_load", oc.LOADED, oc.key_text(keys, chosen), detail=made_up)


def incremental_load(
    spark: SparkSession,
    source: str,
    backup: str | None = None,
    gate: str = "same_key_count",
    suffix: str = catalog.DEFAULT_SUFFIX,
    stringify_keys: bool = False,
    location_root: str | None = None,
) -> oc.Outcome:
    """Copy the newest partition of ``source`` unless a count gate says it is there.

    ``gate="same_key_count"`` (default) loads when the backup partition of
    the same key is absent or has another row count; ``gate="latest_count"``
    compares with the backup's own newest partition (historical behaviour);
    ``gate="same_key_content"`` also reloads a backup partition whose count
    is right but whose rows differ (fingerprints of that one partition; the
    backup's is kept and only the source is read while its files are the same).
    An empty backup is always loaded, and so is one whose files of that
    partition are older than a column of the table.
    """
    if gate not in INCREMENTAL_GATES:
        raise ValueError(f"unknown gate {gate!r}")
    backup = backup or catalog.backup_name(source, suffix)
    keys, done = _partitioned_source(spark, source, backup, "incremental_load")
    if done:
        return done
    made_up, refused = _finished(spark, source, backup, "incremental_load")
    if refused:
        return refused
    prod_keys = catalog_listing(spark, source)
    newest = newest_keys(prod_keys, keys, 1)
    if not newest:
        return oc.Outcome(source, backup, "incremental_load", oc.EMPTY_SOURCE, detail=made_up)
    location = backup_location(backup, location_root)
    prod = catalog.read(spark, source)
    labels = oc.key_text(keys, newest)

    def load(detail: str, **counts) -> oc.Outcome:
        try:
            journal.run(spark, journal.Load(source, backup, keys, newest, stringify_keys, location))
        except tables.SchemaDrift as drift:
            return oc.Outcome(source, backup, "incremental_load", oc.SCHEMA_DRIFT, labels, **counts, detail=str(drift))
        if gate == "same_key_content":
            ledger.record(spark, source, backup, keys, newest)
        return oc.Outcome(source, backup, "incremental_load", oc.LOADED, labels, **counts, detail=_detail(made_up, detail))

    if not catalog.exists(spark, backup):
        return load("backup was empty")
    bkup = catalog.read(spark, backup)
    bkup_keys = catalog_listing(spark, backup)
    if not bkup_keys.take(1):
        return load("backup was empty")
    fault = tables.drift(prod, backup)
    if fault:
        return oc.Outcome(source, backup, "incremental_load", oc.SCHEMA_DRIFT, labels, detail=fault)
    if tables.gained_columns(prod, backup):
        return load("the source gained columns")
    if tables.predating(rows_of(bkup, keys, newest), catalog.data_columns(spark, backup)):
        return load("the backup's files lack columns")
    if gate == "same_key_count":
        verdict = gates.same_key_count(prod, bkup, keys, prod_keys=prod_keys).first()
    elif gate == "same_key_content":
        verdict = ledger.content_verdict(spark, source, backup, keys, newest[0])
        if verdict is None:
            verdict = gates.same_key_content(prod, bkup, keys, prod_keys=prod_keys).first()
            if not verdict["should_load"]:
                ledger.record(spark, source, backup, keys, newest)
    else:
        # keys kept as text have the order of the source's key types
        typed = typed_like(bkup_keys, prod, keys)
        verdict = gates.latest_count(prod, typed_like(bkup, prod, keys), keys, prod_keys=prod_keys, bkup_keys=typed).first()
    counts = dict(prod_rows=verdict["prod_rows"], bkup_rows=verdict["bkup_rows"])
    if not verdict["should_load"]:
        status = oc.SKIPPED_SAME_CONTENT if gate == "same_key_content" else oc.SKIPPED_SAME_COUNT
        return oc.Outcome(source, backup, "incremental_load", status, labels, **counts, detail=_detail(made_up, gate))
    return load(gate, **counts)


def snapshot_unpartitioned(
    spark: SparkSession,
    source: str,
    backup: str | None = None,
    suffix: str = catalog.DEFAULT_SUFFIX,
    location_root: str | None = None,
) -> oc.Outcome:
    """Copy a whole unpartitioned table unless the backup has the same row count (and all columns in its files)."""
    backup = backup or catalog.backup_name(source, suffix)
    if not catalog.exists(spark, source):
        return oc.Outcome(source, backup, "snapshot", oc.MISSING_SOURCE)
    made_up, refused = _finished(spark, source, backup, "snapshot")
    if refused:
        return refused
    prod = catalog.read(spark, source)
    whole = journal.Load(source, backup, location=backup_location(backup, location_root))

    def load(detail: str = "", **counts) -> oc.Outcome:
        journal.run(spark, whole)
        return oc.Outcome(source, backup, "snapshot", oc.LOADED, **counts, detail=_detail(made_up, detail))

    if not catalog.exists(spark, backup):
        return load("backup created")
    fault = tables.drift(prod, backup)
    if fault:
        return oc.Outcome(source, backup, "snapshot", oc.SCHEMA_DRIFT, detail=fault)
    if tables.gained_columns(prod, backup):
        return load("the source gained columns")
    bkup = catalog.read(spark, backup)
    if tables.predating(bkup, bkup.columns):
        return load("the backup's files lack columns")
    verdict = gates.full_count(prod, bkup).first()
    counts = dict(prod_rows=verdict["prod_rows"], bkup_rows=verdict["bkup_rows"])
    if not verdict["should_load"]:
        return oc.Outcome(source, backup, "snapshot", oc.SKIPPED_SAME_COUNT, **counts, detail=made_up)
    return load(**counts)
