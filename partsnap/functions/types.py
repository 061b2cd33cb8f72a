"""Which values of one type can be stored as another, without loss."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

# Types that a value can be widened to without loss (fixed values).
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


def fits(source: DataType, target: DataType, is_key: bool = False) -> bool:
    """Every value of ``source`` can be stored as ``target`` (keys may be kept as text).

    Nested types fit if all their parts do, with the same struct fields in the same
    order: a cast between structs goes by place, not by name.
    """
    if source == target or (is_key and isinstance(target, StringType)):
        return True
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        return fits(source.elementType, target.elementType)
    if isinstance(source, MapType) and isinstance(target, MapType):
        return source.keyType == target.keyType and fits(source.valueType, target.valueType)
    if isinstance(source, StructType) and isinstance(target, StructType):
        same = [f.name for f in source.fields] == [f.name for f in target.fields]
        return same and all(fits(s.dataType, t.dataType) for s, t in zip(source.fields, target.fields, strict=True))
    return target.simpleString() in WIDER.get(source.simpleString(), ())
