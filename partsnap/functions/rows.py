"""Expressions that make whole rows comparable and groupable.

A row is compared by grouping on all of its columns: grouping in Spark is
null-safe (``NULL`` meets ``NULL``, the text ``'null'`` does not), and NaN
and -0.0 are normalised by the optimizer, so a diff never needs a join on N
nullable columns.

Map columns are the one type Spark refuses to group or compare; they are
rewritten (recursively, through arrays and structs) into sorted arrays of
entries, and turned back into maps for output.

Expressions are produced as SQL text, one string per projected column, so a
projection of any width costs one call into the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import ArrayType, DataType, MapType, StructType

SIDE = "_side"

# Fixed labels of the two sides in every report.
PROD = "prod"
BKUP = "bkup"


def ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def has_map(dtype: DataType) -> bool:
    """True when ``dtype`` is or contains a map."""
    if isinstance(dtype, MapType):
        return True
    if isinstance(dtype, ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return False


def comparable_sql(expr: str, dtype: DataType, depth: int = 0) -> str:
    """SQL for ``expr`` rewritten so it can be grouped, compared and counted distinct.

    Maps become ``array_sort(map_entries(m))``; values that are themselves maps
    are rewritten first, so nested maps compare by content, not entry order.
    Every other type is returned unchanged.
    """
    if not has_map(dtype):
        return expr
    v = f"_v{depth}"
    if isinstance(dtype, MapType):
        entries = f"map_entries({expr})"
        if has_map(dtype.valueType):
            inner = comparable_sql(f"{v}.value", dtype.valueType, depth + 1)
            entries = f"transform({entries}, {v} -> struct({v}.key as key, {inner} as value))"
        return f"array_sort({entries})"
    if isinstance(dtype, ArrayType):
        return f"transform({expr}, {v} -> {comparable_sql(v, dtype.elementType, depth + 1)})"
    assert isinstance(dtype, StructType)
    fields = ", ".join(
        f"{comparable_sql(f'{expr}.{ident(f.name)}', f.dataType, depth)} as {ident(f.name)}" for f in dtype.fields
    )
    return f"if({expr} is null, null, struct({fields}))"


def restore_sql(expr: str, dtype: DataType, depth: int = 0) -> str:
    """Inverse of :func:`comparable_sql`: sorted entry arrays back into maps."""
    if not has_map(dtype):
        return expr
    v = f"_v{depth}"
    if isinstance(dtype, MapType):
        entries = expr
        if has_map(dtype.valueType):
            inner = restore_sql(f"{v}.value", dtype.valueType, depth + 1)
            entries = f"transform({expr}, {v} -> struct({v}.key as key, {inner} as value))"
        return f"map_from_entries({entries})"
    if isinstance(dtype, ArrayType):
        return f"transform({expr}, {v} -> {restore_sql(v, dtype.elementType, depth + 1)})"
    assert isinstance(dtype, StructType)
    fields = ", ".join(
        f"{restore_sql(f'{expr}.{ident(f.name)}', f.dataType, depth)} as {ident(f.name)}" for f in dtype.fields
    )
    return f"if({expr} is null, null, struct({fields}))"


def comparable_columns_sql(schema: StructType, columns: Sequence[str]) -> list[str]:
    """Each column, rewritten by :func:`comparable_sql`, under its own name."""
    types = {f.name: f.dataType for f in schema.fields}
    return [f"{comparable_sql(ident(c), types[c])} as {ident(c)}" for c in columns]


def restored_columns_sql(schema: StructType, columns: Sequence[str]) -> list[str]:
    """Inverse of :func:`comparable_columns_sql` (maps rebuilt), under the same names."""
    types = {f.name: f.dataType for f in schema.fields}
    return [f"{restore_sql(ident(c), types[c])} as {ident(c)}" for c in columns]


def side_tag_sql(label: str) -> str:
    """Literal column naming the side a row came from."""
    return f"{text(label)} as {SIDE}"
