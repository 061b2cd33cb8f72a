"""Schema of a table and its backup, side by side.

One row per column name with its position, type and key flag on each side
(from ``df.schema``) and a status.  Names meet as Spark resolves them, without
regard to case unless ``spark.sql.caseSensitive`` is set, so they meet here as
they do in the diff.  With ``filled`` the rows that have a value are counted too,
by one aggregate a side, so a missing column shows what it loses.

:func:`schema_tree` goes into nested types: one row per field path (struct field,
array element, map key and value), so that one field moved or widened inside a
struct is told as that and not as another type of the whole column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from partsnap.functions.rows import BKUP, PROD, SIDE, ident
from partsnap.functions.types import fits

# Fixed status labels of a schema row.
SAME = "same"
MISSING_IN_BKUP = "missing_in_bkup"
MISSING_IN_PROD = "missing_in_prod"
TYPE_DIFFERS = "type_differs"
MOVED = "moved"
RENAMED = "case_differs"
WIDENED = "widened"
NULLABLE = "nullability_differs"

SCHEMA_DDL = "column string, position int, type string, is_key boolean"


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") == "true"


def schema_frame(spark: SparkSession, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``column, position, type, is_key`` for every field of ``df``."""
    rows = [(f.name, i, f.dataType.simpleString(), f.name in keys) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, SCHEMA_DDL)


def filled_rows(df: DataFrame) -> DataFrame:
    """``column, filled``: the rows that have a value, by column, from one aggregate."""
    counts = df.agg(*[F.count(F.col(ident(c))).alias(f"c{i}") for i, c in enumerate(df.columns)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*pairs)))


def schema_compare(
    prod: DataFrame,
    bkup: DataFrame,
    prod_keys: Sequence[str] = (),
    bkup_keys: Sequence[str] = (),
    filled: bool = False,
) -> DataFrame:
    """One row per column name found on either side, with a status.

    ``filled`` adds ``prod_filled`` and ``bkup_filled``, the rows with a value.
    The name is spelled as in prod where prod has it.
    """
    spark = prod.sparkSession
    tagged = schema_frame(spark, prod, prod_keys).withColumn(SIDE, F.lit(PROD)).unionByName(
        schema_frame(spark, bkup, bkup_keys).withColumn(SIDE, F.lit(BKUP))
    )
    parts = ["position", "type", "is_key"]
    if filled:
        parts.append("filled")
        for side, df in ((PROD, prod), (BKUP, bkup)):
            counted = filled_rows(df).withColumn(SIDE, F.lit(side))
            tagged = tagged.unionByName(counted, allowMissingColumns=True)

    def pick(side: str, c: str):
        return F.max(F.when(F.col(SIDE) == side, F.col(c))).alias(f"{side}_{c}")

    norm = F.col("column") if case_sensitive(spark) else F.lower("column")
    name = F.coalesce(F.max(F.when(F.col(SIDE) == PROD, F.col("column"))), F.max("column")).alias("column")
    merged = tagged.groupBy(norm.alias("_norm")).agg(name, *[pick(s, c) for s in (PROD, BKUP) for c in parts]).drop("_norm")
    status = (
        F.when(F.col("bkup_type").isNull(), F.lit(MISSING_IN_BKUP))
        .when(F.col("prod_type").isNull(), F.lit(MISSING_IN_PROD))
        .when(F.col("prod_type") != F.col("bkup_type"), F.lit(TYPE_DIFFERS))
        .when(F.col("prod_position") != F.col("bkup_position"), F.lit(MOVED))
        .otherwise(F.lit(SAME))
    )
    return merged.withColumn("status", status)


def tree_rows(dtype: DataType, path: str = "", position: int = 0, nullable: bool = True) -> Iterator[tuple[str, int, DataType, bool]]:
    """(path, position among its siblings, type, nullable) of a type and all its parts."""
    if path:
        yield path, position, dtype, nullable
    inner = f"{path}." if path else ""
    if isinstance(dtype, StructType):
        for i, f in enumerate(dtype.fields):
            yield from tree_rows(f.dataType, f"{inner}{f.name}", i, f.nullable)
    elif isinstance(dtype, ArrayType):
        yield from tree_rows(dtype.elementType, f"{inner}element", 0, dtype.containsNull)
    elif isinstance(dtype, MapType):
        yield from tree_rows(dtype.keyType, f"{inner}key", 0, False)
        yield from tree_rows(dtype.valueType, f"{inner}value", 1, dtype.valueContainsNull)


def _own_type(dtype: DataType) -> str:
    """The type without its parts, which have rows of their own."""
    kinds = {StructType: "struct", ArrayType: "array", MapType: "map"}
    return kinds.get(type(dtype), dtype.simpleString())


def filled_paths(df: DataFrame) -> DataFrame:
    """``path, filled``: the rows with a value at each path (in an array or map: at any element), from one aggregate."""

    def values(dtype: DataType, expr: str, path: str, depth: int) -> Iterator[tuple[str, str]]:
        yield path, f"{expr} is not null"
        v = f"_f{depth}"
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                yield from values(f.dataType, f"{expr}.{ident(f.name)}", f"{path}.{f.name}", depth)
        parts = []
        if isinstance(dtype, ArrayType):
            parts = [("element", dtype.elementType, expr)]
        elif isinstance(dtype, MapType):
            parts = [("key", dtype.keyType, f"map_keys({expr})"), ("value", dtype.valueType, f"map_values({expr})")]
        for name, part, array in parts:
            for sub, holds in values(part, v, f"{path}.{name}", depth + 1):
                yield sub, f"exists({array}, {v} -> {holds})"

    found = [x for f in df.schema.fields for x in values(f.dataType, ident(f.name), f.name, 0)]
    counts = df.selectExpr(*[f"count_if({holds}) as c{i}" for i, (_, holds) in enumerate(found)])
    pairs = [F.struct(F.lit(path).alias("path"), F.col(f"c{i}").alias("filled")) for i, (path, _) in enumerate(found)]
    return counts.select(F.inline(F.array(*pairs)))


def schema_tree(prod: DataFrame, bkup: DataFrame, keys: Sequence[str] = (), filled: bool = False) -> DataFrame:
    """``path``, position, type and nullability on both sides, and ``status``, for every field path of either side.

    ``status`` is the first that holds of ``missing_in_bkup``, ``missing_in_prod``,
    ``widened`` (every value fits the backup's type: a load takes it),
    ``type_differs``, ``moved``, ``case_differs``, ``nullability_differs`` and ``same``.
    A struct, array or map has its own row, which is ``same`` if only parts of it
    differ.  ``filled`` adds ``prod_filled`` and ``bkup_filled``.
    """
    spark = prod.sparkSession
    exact = case_sensitive(spark)
    norm = (lambda c: c) if exact else str.lower
    sides = [{norm(r[0]): r for r in tree_rows(df.schema)} for df in (prod, bkup)]
    key_names = {norm(k) for k in keys}
    rows = []
    for path in dict.fromkeys([*sides[0], *sides[1]]):
        p, b = sides[0].get(path), sides[1].get(path)
        if p is None or b is None:
            status = MISSING_IN_PROD if p is None else MISSING_IN_BKUP
        elif _own_type(p[2]) != _own_type(b[2]):
            as_text = path in key_names and isinstance(b[2], StringType)
            status = WIDENED if as_text or fits(p[2], b[2]) else TYPE_DIFFERS
        elif p[1] != b[1]:
            status = MOVED
        elif p[0].rpartition(".")[2] != b[0].rpartition(".")[2]:
            status = RENAMED
        else:
            status = SAME if p[3] == b[3] else NULLABLE
        shown = [x for r in (p, b) for x in ((r[1], _own_type(r[2]), r[3]) if r else (None,) * 3)]
        rows.append(((p or b)[0], *shown, status))
    columns = [f"{s}_{c}" for s in (PROD, BKUP) for c in ("position int", "type string", "nullable boolean")]
    tree = spark.createDataFrame(rows, ", ".join(["path string", *columns, "status string"]))
    if not filled:
        return tree
    for side, df in ((PROD, prod), (BKUP, bkup)):
        on = F.col("path") if exact else F.lower("path")
        counted = filled_paths(df).select(on.alias("_norm"), F.col("filled").alias(f"{side}_filled"))
        tree = tree.join(counted, on == F.col("_norm"), "left").drop("_norm")
    return tree
