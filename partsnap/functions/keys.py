"""Predicates and orderings over partition-key columns.

Keys are typed columns, never ``k=v/k=v`` text.  "Newest" is the descending
order of the whole key tuple, with a NULL key counted as the oldest value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, Row
from pyspark.sql import functions as F

from partsnap.functions.rows import ident


def newest_first(keys: Sequence[str]) -> list[Column]:
    """Sort order of key tuples, newest first, NULL keys last (oldest)."""
    return [F.col(ident(k)).desc_nulls_last() for k in keys]


def _key_tuple(value, keys: Sequence[str]) -> tuple:
    if isinstance(value, Row):
        return tuple(value[k] for k in keys)
    if isinstance(value, dict):
        return tuple(value[k] for k in keys)
    if isinstance(value, (tuple, list)):
        return tuple(value)
    return (value,)


def key_in(keys: Sequence[str], values: Iterable) -> Column:
    """True when the row's key tuple is one of ``values``.

    ``values`` are key tuples (``Row``, dict, tuple, or a scalar for one key).
    A ``None`` in a value matches a NULL key.  Single keys become ``IN`` (plus
    ``IS NULL``), which Spark turns into partition filters and parquet
    pushdown; tuples become a ``struct(keys) IN (...)`` that Spark plans as a set
    lookup (NULL fields match NULL fields), so a list of thousands of
    partitions stays one constant-time test instead of a chain that grows
    with the list.  The result may be NULL for a NULL key that was not asked
    for; use :func:`key_not_in` for the complement.
    """
    tuples = list(dict.fromkeys(_key_tuple(v, keys) for v in values))
    if not tuples:
        return F.lit(False)
    if len(keys) == 1:
        col = F.col(ident(keys[0]))
        present = [t[0] for t in tuples if t[0] is not None]
        wants_null = len(present) < len(tuples)
        if not present:
            return col.isNull()
        return (col.isin(present) | col.isNull()) if wants_null else col.isin(present)
    probe = F.struct(*[F.col(ident(k)).alias(k) for k in keys])
    return probe.isin([F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, t)]) for t in tuples])


def key_not_in(keys: Sequence[str], values: Iterable) -> Column:
    """Exact complement of :func:`key_in`; never NULL, so NULL keys are kept."""
    return ~F.coalesce(key_in(keys, values), F.lit(False))
