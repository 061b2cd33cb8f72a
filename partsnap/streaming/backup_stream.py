"""Keep a backup in step with a partitioned file-source table as data lands.

The incremental load re-expressed as a stream: ``readStream.table(source)``
yields the files added since the last checkpointed run; for each micro-batch
the partitions it touches (those retention will keep) are copied whole from
the source table into the backup (dynamic overwrite), then retention trims
the backup.  Re-running a
batch after a failure rewrites the same partitions with the same rows, so
the effect is exactly once.  ``availableNow`` processes what is there and
stops, which is how a daily run is scheduled; ``processing_time`` keeps the
query running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from partsnap.functions.rows import ident
from partsnap.operators.slices import rows_of
from partsnap.plans.retention import apply_eviction
from partsnap.session import shared_dir
from partsnap.sinks import tables
from partsnap.sources import catalog
from partsnap.sources.partitions import catalog_listing, newest_keys


def worth_copying(
    spark: SparkSession, backup: str, touched: list[Row], schema: StructType, keep: int | None
) -> list[Row]:
    """The touched key tuples (typed by ``schema``) that retention will keep.

    With ``keep``, only the ``keep`` newest of (touched ∪ already backed up)
    survive the batch, so older touched partitions are not copied at all:
    the first batch over a table with years of partitions copies ``keep`` of
    them, not all of them only to drop most right after.
    """
    if not keep or not touched:
        return touched
    keys = schema.fieldNames()
    candidates = spark.createDataFrame(touched, schema)
    if catalog.exists(spark, backup):
        listed = catalog_listing(spark, backup)
        candidates = candidates.unionByName(
            listed.select(*[F.col(ident(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
        )
    # a touched partition is often backed up already: it must count once
    survivors = {tuple(r) for r in newest_keys(candidates.distinct(), keys, keep)}
    return [t for t in touched if tuple(t) in survivors]


def backup_batch(spark: SparkSession, source: str, backup: str, keys: list[str], keep: int | None):
    """The ``foreachBatch`` body: copy the partitions the batch touched that retention keeps."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        key_cols = batch.select(*[ident(k) for k in keys])
        touched = key_cols.distinct().collect()
        if not touched:
            return
        wanted = worth_copying(spark, backup, touched, key_cols.schema, keep)
        tables.create_backup_like(spark, source, backup)
        if wanted:
            tables.overwrite_partitions(rows_of(spark.table(source), keys, wanted), backup, wanted)
        if keep:
            apply_eviction(spark, backup, keep, run_id=f"epoch-{epoch_id}", source=source)

    return run


def start_backup_stream(
    spark: SparkSession,
    source: str,
    backup: str | None = None,
    keep: int | None = None,
    checkpoint: str | None = None,
    processing_time: str | None = None,
    suffix: str = catalog.DEFAULT_SUFFIX,
) -> StreamingQuery:
    """Start the stream; with no ``processing_time`` it stops once caught up."""
    keys = catalog.partition_columns(spark, source)
    if not keys:
        raise ValueError(f"{source} is not partitioned")
    backup = backup or catalog.backup_name(source, suffix)
    if not checkpoint and not spark.conf.get("spark.checkpoint.dir", None):
        raise ValueError("pass checkpoint, or set spark.checkpoint.dir: a stream must find its place again")
    location = checkpoint or f"{shared_dir(spark)}/partsnap/streams/{backup}"
    writer = (
        spark.readStream.table(source)
        .writeStream.foreachBatch(backup_batch(spark, source, backup, keys, keep))
        .option("checkpointLocation", location)
        .queryName(f"partsnap_backup_{backup.replace('.', '_')}")
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
