"""Helpers shared by the operators: lineage cuts, native text columns, ids."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names (a local one only if a local session has none)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        folder = tempfile.mkdtemp(prefix="partsnap-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and go on from there.

    The folder is the one of ``spark.checkpoint.dir``; only a local session
    that has none (tests) gets a folder of its own.  With ``drop_shuffles`` the
    shuffle files behind ``df`` go once it is written, as nothing reads them
    again, instead of when the driver next collects garbage.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    if not drop_shuffles:
        return df.checkpoint()
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint()  # a query takes the setting over when it is made
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def words_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A repeatable number in (0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", *parts))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
