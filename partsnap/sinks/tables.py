"""The only module that writes.

* :func:`create_backup_like` creates the backup table from the source schema
  (parquet, same partition columns, optionally keys kept as text);
* :func:`overwrite_partitions` replaces exactly the partitions present in
  the written rows (dynamic overwrite), leaving every other one untouched.
  Backups created here carry the table option
  ``partitionOverwriteMode=dynamic``, so every ``INSERT OVERWRITE`` into them
  (from this code, SQL or any other writer) replaces only the partitions it
  writes, whatever the session setting; the session switch is only a
  fallback for backup tables created elsewhere;
* :func:`overwrite_table` replaces a whole unpartitioned table;
* :func:`drop_partitions` drops partitions by typed key tuples;
  :func:`evict_partitions` also removes their files when the table is
  external (a drop keeps them there);
* :func:`write_manifest` records what is about to be dropped, in the shared
  folder, before it is dropped.

Writes go through Spark's commit protocol: a task lost mid-write is rerun
and only committed files become visible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField
from pyspark.sql.utils import AnalysisException

from partsnap.functions.rows import ident
from partsnap.functions.types import fits
from partsnap.session import dynamic_partition_overwrite, shared_dir
from partsnap.sinks.files import delete_directories
from partsnap.sources import catalog

FORMAT = "parquet"
DROP_BATCH = 200


def create_backup_like(
    spark: SparkSession,
    source: str,
    backup: str,
    stringify_keys: bool = False,
    location: str | None = None,
) -> bool:
    """Create ``backup`` with the source's columns and partition keys.

    Nothing happens when the backup exists (its schema stays as created;
    :func:`partsnap.operators.schema.schema_compare` shows any drift).
    Returns True when the table was created.
    """
    if catalog.exists(spark, backup):
        return False
    keys = catalog.partition_columns(spark, source)
    src = spark.table(source)
    cols = [c for c in src.columns if c not in keys]
    shape = src.selectExpr(
        *[ident(c) for c in cols],
        *[(f"cast({ident(k)} as string) as {ident(k)}" if stringify_keys else ident(k)) for k in keys],
    )
    writer = shape.limit(0).write.format(FORMAT).mode("ignore")
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(backup)
    return True


def create_table_like(spark: SparkSession, source: str, table: str, location: str | None = None) -> bool:
    """Create the unpartitioned ``table`` with the source's columns, empty; True when it was created."""
    if catalog.exists(spark, table):
        return False
    writer = spark.table(source).limit(0).write.format(FORMAT).mode("ignore")
    (writer.option("path", location) if location else writer).saveAsTable(table)
    return True


def create_table_partitioned(like: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Create ``table`` with the columns of ``like``, empty, its partitions replaced one by one by overwrites."""
    writer = like.limit(0).write.format(FORMAT).mode("ignore").partitionBy(*keys)
    writer.option("partitionOverwriteMode", "dynamic").saveAsTable(table)


class SchemaDrift(Exception):
    """The source no longer fits its backup; nothing was written."""


def drift(df: DataFrame, table: str) -> str:
    """Why ``table`` cannot take ``df`` whole; empty if it can.

    A column that the source lost and one whose type does not widen to the
    backup's are faults; a gained column is not (:func:`reconcile` adds it).
    """
    spark = df.sparkSession
    keys = {k.lower() for k in catalog.partition_columns(spark, table)}
    source = {f.name.lower(): f for f in df.schema.fields}
    faults = []
    for f in spark.table(table).schema.fields:
        mine = source.get(f.name.lower())
        if mine is None:
            faults.append(f"column {f.name} is gone from the source")
        elif not fits(mine.dataType, f.dataType, f.name.lower() in keys):
            faults.append(f"column {f.name} is {mine.dataType.simpleString()} in the source and {f.dataType.simpleString()} in the backup")
    return "; ".join(faults)


def gained_columns(df: DataFrame, table: str) -> list[StructField]:
    """Columns of ``df`` that ``table`` does not have yet."""
    held = {c.lower() for c in df.sparkSession.table(table).columns}
    return [f for f in df.schema.fields if f.name.lower() not in held]


def reconcile(df: DataFrame, table: str) -> bool:
    """Add the columns that ``df`` gained to ``table`` (older rows read as NULL there); True if there are any.

    Raises :class:`SchemaDrift`, before anything is written, if :func:`drift` finds a fault.
    """
    spark = df.sparkSession
    fault = drift(df, table)
    if fault:
        raise SchemaDrift(fault)
    gained = gained_columns(df, table)
    if gained:
        listed = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in gained)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return bool(gained)


def predating(rows: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the files behind ``rows`` (of a stored Parquet table) do not hold.

    They were added to the table after the files were written, so they read as
    NULL.  One file's footer is read, no data; a partition's files are of one
    write.
    """
    paths = rows.inputFiles()
    if not paths or not paths[0].lower().endswith(f".{FORMAT}"):
        return []
    held = {c.lower() for c in rows.sparkSession.read.parquet(unquote(paths[0])).columns}
    return [c for c in columns if c.lower() not in held]


def _conform(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """Columns in the table's order and types (``insertInto`` is positional), after :func:`reconcile`."""
    reconcile(df, table)
    target = spark.table(table).schema
    return df.select(*[F.col(ident(f.name)).cast(f.dataType).alias(f.name) for f in target.fields])


def declares_dynamic_overwrite(spark: SparkSession, table: str) -> bool:
    """True when ``table`` was created with ``partitionOverwriteMode=dynamic``."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Storage Properties'").collect()
    return any("partitionoverwritemode=dynamic" in (r["data_type"] or "").lower() for r in rows)


def overwrite_partitions(df: DataFrame, table: str, replaced: Sequence = ()) -> None:
    """Replace the partitions of ``table`` that occur in ``df``; keep the rest.

    Partitions listed in ``replaced`` (key tuples) that have no row in ``df``
    become empty, as a static partition overwrite with no rows leaves them.
    """
    spark = df.sparkSession
    rows = _conform(df, spark, table)
    if declares_dynamic_overwrite(spark, table):
        rows.write.insertInto(table, overwrite=True)
    else:
        with dynamic_partition_overwrite(spark):
            rows.write.insertInto(table, overwrite=True)
    if replaced:
        keys = catalog.partition_columns(spark, table)
        filled = {tuple(r) for r in df.select(*[ident(k) for k in keys]).distinct().collect()}
        empty_partitions(spark, table, keys, [v for v in replaced if tuple(v[k] for k in keys) not in filled])


def empty_partitions(spark: SparkSession, table: str, keys: Sequence[str], values: Sequence) -> None:
    """Leave the partitions ``values`` registered and without rows."""
    evict_partitions(spark, table, keys, values)
    for v in values:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition_spec(keys, v)}")


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace every row of an unpartitioned ``table`` with ``df``."""
    spark = df.sparkSession
    _conform(df, spark, table).write.insertInto(table, overwrite=True)


def _spec_literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat()
    else:
        text = str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(keys: Sequence[str], value: Row | dict | tuple) -> str:
    """``PARTITION (k1='v1', k2=null)`` for one key tuple."""
    vals = [value[k] for k in keys] if isinstance(value, (Row, dict)) else list(value)
    inner = ", ".join(f"`{k}`={_spec_literal(v)}" for k, v in zip(keys, vals))
    return f"PARTITION ({inner})"


def drop_partitions(spark: SparkSession, table: str, keys: Sequence[str], values: Sequence) -> int:
    """Drop the partitions ``values`` (key tuples) of ``table``; missing ones are ignored.

    A managed table loses the partition directories too.  Returns the number
    of key tuples asked for.
    """
    values = list(values)
    for i in range(0, len(values), DROP_BATCH):
        specs = ", ".join(partition_spec(keys, v) for v in values[i : i + DROP_BATCH])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return len(values)


def is_external(spark: SparkSession, table: str) -> bool:
    """True for a table whose files outlive its partitions (``DROP`` keeps them)."""
    return spark.catalog.getTable(table).tableType == "EXTERNAL"


def partition_location(spark: SparkSession, table: str, keys: Sequence[str], value) -> str | None:
    """Directory of one partition, from the catalog; None when the partition is gone.

    Only a directory strictly inside the table's own location is returned: a
    partition registered elsewhere (Hive allows any path) may share its
    folder with other data, so its files are never deleted from here.
    """
    try:
        described = spark.sql(f"DESCRIBE FORMATTED {table} {partition_spec(keys, value)}")
        found = [r["data_type"] for r in described.where("col_name = 'Location'").collect()]
    except AnalysisException:
        return None
    if len(found) < 2:
        return None
    part, root = found[0].rstrip("/"), found[1].rstrip("/")
    return part if part.startswith(root + "/") else None


def evict_partitions(spark: SparkSession, table: str, keys: Sequence[str], values: Sequence) -> int:
    """Drop the partitions ``values`` and remove their files, managed or external.

    A managed table's drop deletes the directories.  An external table keeps
    them (and ``RECOVER PARTITIONS`` would bring the rows back), so their
    directories (those inside the table's location, see
    :func:`partition_location`) are deleted first, then the partitions are
    dropped: a crash in between leaves partitions that read as empty, and a
    rerun, which plans the same evictions from the catalog, finishes the
    drop.
    """
    values = list(values)
    if values and is_external(spark, table):
        locations = [partition_location(spark, table, keys, v) for v in values]
        delete_directories(spark, [loc for loc in locations if loc])
    return drop_partitions(spark, table, keys, values)


def manifest_path(spark: SparkSession, table: str, run_id: str) -> str:
    return f"{shared_dir(spark)}/partsnap/evictions/{table}/{run_id}"


def write_manifest(keys_df: DataFrame, path: str) -> None:
    """Persist a (small) key list before acting on it; a rerun can read it back."""
    keys_df.coalesce(1).write.mode("overwrite").parquet(path)
