"""Partition-key listings.

Two sources of the same listing:

* :func:`listing` reads key values from the data of any DataFrame
  (for a partitioned parquet table Spark reads only partition values);
* :func:`catalog_listing` asks the catalog (``SHOW PARTITIONS``), a metadata
  call that also sees partitions holding no rows.

Both return a small DataFrame with one row per key tuple, typed like the key
columns.  Only top-k / offset slices of it (bounded by the number of
partitions asked for) are ever brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from partsnap.functions.keys import newest_first
from partsnap.functions.rows import ident, text
from partsnap.sources import catalog

# Fixed value: the directory name Hive-style catalogs give a NULL key.
NULL_KEY_TEXT = "__HIVE_DEFAULT_PARTITION__"


def listing(df: DataFrame, keys: Sequence[str], with_counts: bool = False) -> DataFrame:
    """Distinct key tuples of ``df`` (optionally with ``row_count`` per key)."""
    names = [ident(k) for k in keys]
    if with_counts:
        return df.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count"))
    return df.selectExpr(*names).distinct()


def catalog_listing(spark: SparkSession, table: str) -> DataFrame:
    """Key tuples registered in the catalog for ``table``, typed, from metadata only.

    ``SHOW PARTITIONS`` text (``k1=v1/k2=v2``, values path-escaped) is taken
    apart by Spark: ``/`` and ``=`` inside values are escaped, so splitting is
    safe; the NULL marker becomes NULL; ``%XX`` escapes are decoded (a ``+``
    is not escaped by the catalog, so it is protected from the decoder); each
    field is cast to its key column's type.  The listing stays a DataFrame.
    """
    keys = catalog.partition_columns(spark, table)
    if not keys:
        raise ValueError(f"{table} is not partitioned")
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    try:
        shown = spark.sql(f"SHOW PARTITIONS {table}")
    except AnalysisException:
        # Table formats without a partition listing: read the key values instead.
        return listing(spark.table(table), keys)
    spec = ident(shown.columns[0])
    fields = []
    for i, k in enumerate(keys, start=1):
        raw = f"substring_index(element_at(split({spec}, '/'), {i}), '=', -1)"
        value = f"url_decode(replace({raw}, '+', '%2B'))"
        fields.append(
            f"cast(if({raw} = {text(NULL_KEY_TEXT)}, null, {value}) as {types[k].simpleString()}) as {ident(k)}"
        )
    return shown.selectExpr(*fields)


def newest(keys_df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest key tuples (top-k; planned as TakeOrderedAndProject)."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return keys_df.selectExpr(*[ident(k) for k in keys]).orderBy(*newest_first(keys)).limit(n)


def newest_keys(keys_df: DataFrame, keys: Sequence[str], n: int) -> list[Row]:
    """The ``n`` newest key tuples on the driver (at most ``n`` rows).

    When fewer than ``n`` keys exist, all of them are returned.
    """
    return newest(keys_df, keys, n).collect()


def beyond(keys_df: DataFrame, keys: Sequence[str], keep: int, order_like: DataFrame | None = None) -> DataFrame:
    """Every key tuple after the ``keep`` newest ones (the eviction list).

    With ``order_like`` (the source table), "newest" follows the types of the
    keys there, as a backup may keep its keys as text.
    """
    if keep < 0:
        raise ValueError("keep must not be negative")
    if order_like is None:
        order = newest_first(keys)
    else:
        order = [F.col(ident(k)).cast(order_like.schema[k].dataType).desc_nulls_last() for k in keys]
    ordered = keys_df.orderBy(*order)
    return ordered.offset(keep) if keep else ordered


def typed_like(df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its key columns cast to the types they have in ``source``."""
    return df.withColumns({k: F.col(ident(k)).cast(source.schema[k].dataType) for k in keys})


def has_more_than(keys_df: DataFrame, n: int) -> bool:
    """True when more than ``n`` key tuples exist (reads at most n+1)."""
    return len(keys_df.limit(n + 1).collect()) > n
