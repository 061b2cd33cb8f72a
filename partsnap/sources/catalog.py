"""Catalog reads: table scan, existence, listing, schema and partition columns.

Everything here is metadata; no data is scanned except by :func:`read`,
which returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

DEFAULT_SUFFIX = "_bkup"


def qualified(name: str, database: str | None = None) -> str:
    """``db.table`` when a database is given and the name is bare."""
    return f"{database}.{name}" if database and "." not in name else name


def backup_name(source: str, suffix: str = DEFAULT_SUFFIX) -> str:
    """Name of the backup table kept next to ``source``."""
    return f"{source}{suffix}"


def read(spark: SparkSession, name: str) -> DataFrame:
    """Lazy scan of a catalog table (filters and projections push down)."""
    return spark.table(name)


def exists(spark: SparkSession, name: str) -> bool:
    """Case-insensitive existence check through the catalog."""
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables in ``database`` (the current one when omitted)."""
    return [t.name for t in spark.catalog.listTables(database)]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a catalog table, in declaration order; [] if none."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def is_partitioned(spark: SparkSession, name: str) -> bool | None:
    """True / False for an existing table; None when the table is missing."""
    if not exists(spark, name):
        return None
    return bool(partition_columns(spark, name))


def schema(spark: SparkSession, name: str) -> StructType:
    """Schema of a table without running a job."""
    return spark.table(name).schema


def data_fields(spark: SparkSession, name: str) -> StructType:
    """Schema of the non-partition columns (names and types), in table order."""
    keys = set(partition_columns(spark, name))
    return StructType([f for f in spark.table(name).schema.fields if f.name not in keys])


def data_columns(spark: SparkSession, name: str) -> list[str]:
    """Columns that are not partition columns, in table order."""
    keys = set(partition_columns(spark, name))
    return [c for c in spark.table(name).columns if c not in keys]
