"""Distinct-value profile of every column, production vs backup.

Exact counts (the default) stack each row into ``(column index, value)``
pairs, then count distinct values per index.  Work and shuffle grow with
rows × columns; Spark's own plan for N exact distinct counts (an ``Expand``
that copies every row N times, each copy N columns wide) grows with
rows × columns², which matters for wide tables.

A stacked value travels in one of three typed lanes, so no number is
formatted as text: integers, booleans, dates and instants as ``bigint``
(instants by their microsecond), floating point as ``double`` (grouping
folds ``-0.0`` into ``0.0`` and every NaN into one), everything else as
text (decimals and local timestamps by their exact text, binary as hex,
nested values through ``to_json`` with maps sorted first and ``-0.0`` read
as ``0.0`` inside them).  A NULL leaves
every lane NULL and is not counted, as in ``count(distinct)``.  The
distinct (column, value) pairs are formed with map-side combining, with a flag
for each side that holds the value, so a value held by a third of all rows
costs one row per task, and one that a faithful backup shares is counted for
both sides from one pair.

``approx=True`` uses HyperLogLog++ sketches per column in a single aggregate
(no stacking), for very large profiles where an estimate is enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampType,
)

from partsnap.functions.rows import BKUP, PROD, SIDE, comparable_sql, ident, side_tag_sql, text
from partsnap.operators.diff import align


def _has_float(dtype: DataType) -> bool:
    if isinstance(dtype, (FloatType, DoubleType)):
        return True
    if isinstance(dtype, ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, MapType):
        return _has_float(dtype.valueType)
    if isinstance(dtype, StructType):
        return any(_has_float(f.dataType) for f in dtype.fields)
    return False


def unsigned_zero_sql(expr: str, dtype: DataType, depth: int = 0) -> str:
    """``expr`` with ``-0.0`` turned into ``0.0`` at every floating-point leaf.

    Grouping treats the two zeros as one value (and every NaN as one, which
    ``to_json`` already prints alike); the text of a nested value must too.
    Map keys are left as they are.
    """
    if not _has_float(dtype):
        return expr
    v = f"_z{depth}"
    if isinstance(dtype, (FloatType, DoubleType)):
        return f"({expr} + cast(0 as {dtype.simpleString()}))"
    if isinstance(dtype, ArrayType):
        return f"transform({expr}, {v} -> {unsigned_zero_sql(v, dtype.elementType, depth + 1)})"
    if isinstance(dtype, MapType):
        k = f"_k{depth}"
        return f"transform_values({expr}, ({k}, {v}) -> {unsigned_zero_sql(v, dtype.valueType, depth + 1)})"
    fields = ", ".join(
        f"{unsigned_zero_sql(f'{expr}.{ident(f.name)}', f.dataType, depth)} as {ident(f.name)}"
        for f in dtype.fields
    )
    return f"if({expr} is null, null, struct({fields}))"


def lane_sql(col: str, dtype: DataType) -> tuple[str, str, str]:
    """``(bigint, double, text)`` lanes of a value; exactly one is set unless it is NULL."""
    q = ident(col)
    no_int, no_float, no_text = "cast(null as bigint)", "cast(null as double)", "cast(null as string)"
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return f"cast({q} as bigint)", no_float, no_text
    if isinstance(dtype, BooleanType):
        return f"cast(cast({q} as int) as bigint)", no_float, no_text
    if isinstance(dtype, DateType):
        return f"cast(unix_date({q}) as bigint)", no_float, no_text
    if isinstance(dtype, TimestampType):
        return f"unix_micros({q})", no_float, no_text
    if isinstance(dtype, (DoubleType, FloatType)):
        return no_int, f"cast({q} as double)", no_text
    if isinstance(dtype, StringType):
        return no_int, no_float, q
    if isinstance(dtype, BinaryType):
        return no_int, no_float, f"hex({q})"
    if isinstance(dtype, (ArrayType, StructType, MapType)):
        return no_int, no_float, f"to_json({comparable_sql(unsigned_zero_sql(q, dtype), dtype)})"
    return no_int, no_float, f"cast({q} as string)"


def _stacked(df: DataFrame, cols: Sequence[str], in_prod: bool) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for i, c in enumerate(cols):
        li, ld, ls = lane_sql(c, types[c])
        pairs.append(f"struct({i} as _ps_g, {li} as _ps_i, {ld} as _ps_d, {ls} as _ps_s)")
    return df.selectExpr(f"{str(in_prod).lower()} as _ps_in", f"inline(array({', '.join(pairs)}))")


def _exact(p: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One pipeline for both sides; a global aggregate then ``stack`` always yields two rows."""
    values = (
        _stacked(p, cols, True)
        .union(_stacked(b, cols, False))
        .where("_ps_i is not null or _ps_d is not null or _ps_s is not null")
        .groupBy("_ps_g", "_ps_i", "_ps_d", "_ps_s")
        .agg(F.bool_or("_ps_in").alias("_ps_p"), F.bool_or(~F.col("_ps_in")).alias("_ps_b"))
    )
    per_column = values.groupBy("_ps_g").agg(F.count_if("_ps_p").alias(f"_ps_{PROD}"), F.count_if("_ps_b").alias(f"_ps_{BKUP}"))
    wide = per_column.selectExpr(
        *[
            f"coalesce(max(if(_ps_g = {i}, _ps_{side}, null)), 0L) as _ps_{side}_{i}"
            for side in (PROD, BKUP)
            for i in range(len(cols))
        ]
    )
    fields = ", ".join(
        f"{text(side)}, " + ", ".join(f"_ps_{side}_{i}" for i in range(len(cols))) for side in (PROD, BKUP)
    )
    names = ", ".join([SIDE] + [ident(c) for c in cols])
    return wide.selectExpr(f"stack(2, {fields}) as ({names})")


def _approx(df: DataFrame, cols: Sequence[str], label: str, rsd: float) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(
        side_tag_sql(label),
        *[
            f"approx_count_distinct({comparable_sql(unsigned_zero_sql(ident(c), types[c]), types[c])}, {rsd})"
            f" as {ident(c)}"
            for c in cols
        ],
    )


def distinct_profile(
    prod: DataFrame,
    bkup: DataFrame,
    columns: Sequence[str] | None = None,
    approx: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """Two rows (``_side`` = prod / bkup), one distinct count per column."""
    p, b, cols = align(prod, bkup, columns)
    if approx:
        return _approx(p, cols, PROD, rsd).unionByName(_approx(b, cols, BKUP, rsd))
    return _exact(p, b, cols)
