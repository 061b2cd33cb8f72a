"""Session-level settings the jobs rely on."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# Held for the whole switched write, so concurrent batch threads never see
# each other's restore of the setting in the middle of a write.
_OVERWRITE_SWITCH = threading.RLock()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and manifests.

    Read from the session (``spark.checkpoint.dir`` or a directory set on the
    context); there is no local fallback, because a machine-local folder is
    not visible to other executors.
    """
    # The configured path itself: getCheckpointDir() adds a folder per application.
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return d.rstrip("/")


@contextmanager
def dynamic_partition_overwrite(spark: SparkSession):
    """Overwrite only the partitions present in the written data.

    Fallback for tables without the ``partitionOverwriteMode=dynamic`` table
    option: ``insertInto`` ignores a per-write option, and the default
    (static) mode would truncate every partition of the table, so the
    session setting is switched for the write and restored after.  The
    switch changes the whole session, so switched writes are serialised by
    a lock (the batch runner may write several tables at once); writes into
    tables that carry the table option never take it.
    """
    with _OVERWRITE_SWITCH:
        previous = spark.conf.get(OVERWRITE_MODE, None)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            yield
        finally:
            if previous is None:
                spark.conf.unset(OVERWRITE_MODE)
            else:
                spark.conf.set(OVERWRITE_MODE, previous)
