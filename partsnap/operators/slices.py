"""What a load or a retention pass selects, as plain DataFrames.

These are the pure halves of the table-writing jobs: the rows a load copies,
the table a load leaves behind, the keys a retention pass evicts and the
rows it keeps.  The writers in :mod:`partsnap.sinks.tables` apply them; the
tests compare both.

Key selection is by an explicit list of key tuples (at most ``n`` or
``#partitions`` of them on the driver), which Spark turns into literal
partition filters, so a load reads only the partitions it copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row

from partsnap.functions.keys import key_in, key_not_in
from partsnap.functions.rows import ident
from partsnap.sources.partitions import beyond, listing, newest_keys


def history_keys(prod: DataFrame, keys: Sequence[str], n: int, prod_keys: DataFrame | None = None) -> list[Row]:
    """The ``n`` newest prod key tuples (all of them when fewer exist)."""
    return newest_keys(prod_keys if prod_keys is not None else listing(prod, keys), keys, n)


def history_slice(prod: DataFrame, keys: Sequence[str], n: int, prod_keys: DataFrame | None = None) -> DataFrame:
    """Rows of the ``n`` newest prod partitions."""
    return rows_of(prod, keys, history_keys(prod, keys, n, prod_keys))


def rows_of(df: DataFrame, keys: Sequence[str], key_values: Sequence) -> DataFrame:
    """Rows whose key tuple is in ``key_values`` (NULL keys included when asked)."""
    return df.where(key_in(keys, key_values))


def after_overwrite(bkup: DataFrame, new_rows: DataFrame, keys: Sequence[str], replaced: Sequence) -> DataFrame:
    """The backup as a dynamic partition overwrite of ``replaced`` leaves it.

    Partitions in ``replaced`` now hold exactly ``new_rows``; all others are
    untouched.
    """
    kept = bkup.where(key_not_in(keys, replaced))
    return kept.unionByName(new_rows.selectExpr(*[ident(c) for c in bkup.columns]))


def eviction_keys(bkup: DataFrame, keys: Sequence[str], keep: int, bkup_keys: DataFrame | None = None) -> DataFrame:
    """Key tuples beyond the ``keep`` newest backup partitions."""
    return beyond(bkup_keys if bkup_keys is not None else listing(bkup, keys), keys, keep)


def survivors(bkup: DataFrame, keys: Sequence[str], keep: int, bkup_keys: DataFrame | None = None) -> DataFrame:
    """Backup rows left after keeping the ``keep`` newest partitions."""
    evicted = eviction_keys(bkup, keys, keep, bkup_keys).collect()
    return bkup.where(key_not_in(keys, evicted))
