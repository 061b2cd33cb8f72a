"""Write-ahead records of loads: what is about to change, kept until it has.

A load changes a backup in several steps (create it, add gained columns, write
rows, empty partitions).  A job lost between two of them leaves a backup that the
count gates may take for whole: a column added and never filled reads NULL, with
the right number of rows.  So every load first writes a record (source, backup, key
tuples, how the backup is made) and removes it after its last step; a later run
that finds a record does the whole load over, before it looks at any gate.  Doing
a load twice has the effect of doing it once: partitions are replaced whole.

A record is a folder of its own below ``_partsnap_journal/{database}.{backup}``, written by
Spark (complete once its ``_SUCCESS`` is there; an incomplete one says that
nothing was changed yet).  They are in the shared folder of
``spark.checkpoint.dir``, or in the warehouse if the session names none, so that
the next application finds them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Row, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from partsnap.functions.keys import key_in
from partsnap.operators.slices import rows_of
from partsnap.sinks import files, tables
from partsnap.sources import catalog
from partsnap.sources.partitions import catalog_listing

INTENT = "intent"


@dataclass(frozen=True)
class Load:
    """One load: the partitions ``chosen`` (key tuples) of ``source``, or without ``keys`` the whole table."""

    source: str
    backup: str
    keys: list[str] = field(default_factory=list)
    chosen: Sequence = ()
    stringify_keys: bool = False
    location: str | None = None


def home_of(spark: SparkSession, kind: str, backup: str) -> str:
    """Folder of what is kept about ``backup``; the same one for every application of the cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    name = backup if "." in backup else f"{spark.catalog.currentDatabase()}.{backup}"
    return f"{folder.rstrip('/')}/{kind}/{quote(name.replace('`', '').lower(), safe='')}"


def folder_of(spark: SparkSession, backup: str) -> str:
    return home_of(spark, "_partsnap_journal", backup)


def open_record(spark: SparkSession, load: Load) -> str:
    """Write the record of ``load``; returns its folder."""
    flat = [StructField(n, StringType()) for n in ("source", "backup", "location")] + [StructField("stringify_keys", BooleanType())]
    head = (load.source, load.backup, load.location, load.stringify_keys)
    if load.keys:
        source = spark.table(load.source).schema
        key = StructField("key", StructType([StructField(k, source[k].dataType) for k in load.keys]))
        rows, schema = [(*head, tuple(v[k] for k in load.keys)) for v in load.chosen], StructType([*flat, key])
    else:
        rows, schema = [head], StructType(flat)
    path = f"{folder_of(spark, load.backup)}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{INTENT}")
    return path


def close_record(spark: SparkSession, path: str) -> None:
    """Forget a record; without its ``_SUCCESS`` it counts as never written, should the rest stay behind."""
    files.delete_directories(spark, [f"{path}/{INTENT}/_SUCCESS", path])


def open_records(spark: SparkSession, backup: str) -> list[tuple[str, Load]]:
    """(folder, load) of the records of ``backup`` that no load has closed, oldest first."""
    base = folder_of(spark, backup)
    found = []
    for name in files.children(spark, base):
        path = f"{base}/{name}"
        if "_SUCCESS" not in files.children(spark, f"{path}/{INTENT}"):
            close_record(spark, path)
            continue
        rows = spark.read.parquet(f"{path}/{INTENT}").collect()
        if not rows:
            close_record(spark, path)
            continue
        r = rows[0]
        keys = list(r["key"].__fields__) if "key" in r else []
        chosen = [x["key"] for x in rows] if keys else []
        found.append((path, Load(r["source"], r["backup"], keys, chosen, bool(r["stringify_keys"]), r["location"])))
    return found


def carry_out(spark: SparkSession, load: Load, listed: bool = True) -> list[Row]:
    """All steps of a load; returns the key tuples that the source no longer lists (their backup stays as it is).

    ``listed`` says that the key tuples come from the source's listing just now.
    """
    if not load.keys:
        tables.create_table_like(spark, load.source, load.backup, load.location)
        tables.overwrite_table(catalog.read(spark, load.source), load.backup)
        return []
    tables.create_backup_like(spark, load.source, load.backup, load.stringify_keys, load.location)
    here, gone = list(load.chosen), []
    if not listed:
        held = {tuple(r) for r in catalog_listing(spark, load.source).where(key_in(load.keys, load.chosen)).collect()}
        gone = [v for v in here if tuple(v[k] for k in load.keys) not in held]
        here = [v for v in here if tuple(v[k] for k in load.keys) in held]
    if here:
        tables.overwrite_partitions(rows_of(catalog.read(spark, load.source), load.keys, here), load.backup, here)
    return gone


@contextmanager
def recorded(spark: SparkSession, load: Load):
    """A record around the steps of ``load``.

    It stays if they are lost or fail on the way, and goes if they are refused
    (:class:`tables.SchemaDrift`) before anything was changed.
    """
    path = open_record(spark, load)
    try:
        yield
    except tables.SchemaDrift:
        close_record(spark, path)
        raise
    close_record(spark, path)


def run(spark: SparkSession, load: Load) -> None:
    """``load`` within a record."""
    with recorded(spark, load):
        carry_out(spark, load)


def finish_open(spark: SparkSession, backup: str, told: Callable[[Load], str]) -> str:
    """Do the unfinished loads of ``backup`` over; returns what was done, for the outcome's detail.

    A load that the backup's schema refuses now stays on record, and
    :class:`tables.SchemaDrift` goes on to the caller.
    """
    done = []
    for path, load in open_records(spark, backup):
        gone = carry_out(spark, load, listed=False)
        close_record(spark, path)
        done.append("finished an earlier load of " + told(load) + (f" ({len(gone)} partitions are no longer in the source)" if gone else ""))
    return "; ".join(done)
