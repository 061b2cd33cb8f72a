"""Partition fingerprints: find the partitions that differ before diffing rows.

A backup is mostly an exact copy, so a row diff of two 100 TB tables would
shuffle 200 TB to report a few changed partitions.  Here each side is first
reduced to one small row per partition key: the row count and sums of two
64-bit row hashes, each split into two signed 32-bit halves summed as
``bigint`` (every copy of a row counts).  A sum that leaves the 64-bit range
counts as a difference, so that the exact diff decides.  The hashes start from
different salts; a nested value is hashed level by level, each level with its
NULL flag and, for arrays and maps, its size, so that neither NULL elements
nor the nesting can get lost.  Only partitions whose fingerprints differ go
through the exact row diff, and their key filters prune the scans.

A partition reported as changed is diffed exactly, so a false alarm only
costs work (``-0.0`` is hashed as ``0.0``, as grouping compares it).  A
changed partition is missed only if the count and the sums of both hashes
collide, which is unlikely but possible; the exact
:func:`partsnap.operators.diff.row_diff` remains the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from partsnap.functions.keys import key_in
from partsnap.functions.rows import comparable_sql, ident, text
from partsnap.operators.diff import align, row_diff
from partsnap.operators.profile import unsigned_zero_sql

# Fixed salts of the two hashes.
LANES = ("partsnap-lane-1", "partsnap-lane-2")


def value_hash(expr: str, dtype: DataType, salt: str, depth: int = 0) -> str:
    """64-bit hash of one value, never NULL; ``expr`` has no maps (see ``comparable_sql``)."""
    start = f"{text(salt)}, isnull({expr})"
    if isinstance(dtype, ArrayType):
        v = f"_h{depth}"
        return f"xxhash64({start}, size({expr}), transform({expr}, {v} -> {value_hash(v, dtype.elementType, salt, depth + 1)}))"
    if isinstance(dtype, StructType):
        return f"xxhash64({start}, {', '.join(value_hash(f'{expr}.{ident(f.name)}', f.dataType, salt, depth) for f in dtype.fields) or '0'})"
    return f"xxhash64({start}, {expr})"


def without_maps(dtype: DataType) -> DataType:
    """The type that ``comparable_sql`` gives a value: maps are arrays of entries."""
    if isinstance(dtype, MapType):
        return ArrayType(StructType([StructField("key", dtype.keyType), StructField("value", without_maps(dtype.valueType))]))
    if isinstance(dtype, ArrayType):
        return ArrayType(without_maps(dtype.elementType))
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, without_maps(f.dataType)) for f in dtype.fields])
    return dtype


def _row_hash(schema, cols: Sequence[str], salt: str) -> str:
    """xxhash64 over every column: the salt first, then flat columns with their NULL flags and nested ones by level."""
    types = {f.name: f.dataType for f in schema.fields}
    parts = [text(salt)]
    for c in cols:
        value = comparable_sql(unsigned_zero_sql(ident(c), types[c]), types[c])
        if isinstance(types[c], (ArrayType, MapType, StructType)):
            parts.append(value_hash(f"({value})", without_maps(types[c]), salt))
        else:
            parts += [value, f"isnull({ident(c)})"]
    return f"xxhash64({', '.join(parts)})"


def partition_fingerprints(
    prod: DataFrame, bkup: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """``keys…, prod_rows, bkup_rows``, four hash sums per side, ``changed``.

    One ``groupBy`` over the tagged union; partial sums are combined map-side,
    so the shuffle carries one row per key per task.
    """
    p, b, cols = align(prod, bkup, columns)
    names = [ident(k) for k in keys]
    h1, h2 = (_row_hash(p.schema, cols, salt) for salt in LANES)
    halves = [
        f"shiftright({h1}, 32) as _ps_a",
        f"({h1} & 4294967295L) - 2147483648L as _ps_b",
        f"shiftright({h2}, 32) as _ps_c",
        f"({h2} & 4294967295L) - 2147483648L as _ps_d",
    ]
    tagged = p.selectExpr(*names, "true as _ps_in", *halves).union(b.selectExpr(*names, "false as _ps_in", *halves))
    lanes = ("_ps_a", "_ps_b", "_ps_c", "_ps_d")
    sums = tagged.groupBy(*names).agg(
        F.expr("count_if(_ps_in) as prod_rows"),
        F.expr("count_if(not _ps_in) as bkup_rows"),
        *[F.expr(f"try_sum(if(_ps_in, {x}, 0L)) as prod{x[3:]}") for x in lanes],
        *[F.expr(f"try_sum(if(_ps_in, 0L, {x})) as bkup{x[3:]}") for x in lanes],
    )
    differs = " or ".join(["prod_rows <> bkup_rows"] + [f"coalesce(prod{x[3:]} <> bkup{x[3:]}, true)" for x in lanes])
    return sums.selectExpr("*", f"{differs} as changed")


def changed_keys(
    prod: DataFrame, bkup: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Key tuples of the partitions whose content differs between the sides."""
    return partition_fingerprints(prod, bkup, keys, columns).where("changed").select(*[ident(k) for k in keys])


def pruned_row_diff(
    prod: DataFrame,
    bkup: DataFrame,
    keys: Sequence[str],
    side: str = "both",
    multiset: bool = False,
    columns: Sequence[str] | None = None,
    changed: Sequence | None = None,
) -> DataFrame:
    """:func:`row_diff` restricted to the partitions whose fingerprints differ.

    The changed key list (at most one row per partition) is brought to the
    driver and becomes a literal filter on both sides, which Spark prunes to
    those partitions when the keys are partition columns.  ``changed`` gives the
    list where it is known already.
    """
    if changed is None:
        changed = changed_keys(prod, bkup, keys, columns).collect()
    return row_diff(
        prod.where(key_in(keys, changed)) if changed else prod.limit(0),
        bkup.where(key_in(keys, changed)) if changed else bkup.limit(0),
        side=side,
        multiset=multiset,
        columns=columns,
    )
