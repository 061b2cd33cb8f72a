"""All parts of an audit from one aggregate of the rows.

Both sides are counted by whole row (one exchange of the data).  From that one
result come the totals of every partition, which hold the volume and the
differences, and the distinct values of every column: the exchange is reused, so
each side is scanned once, however many parts are asked for.  Rows of different
partitions are different rows, so totals of a table are sums over its partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsnap.functions.rows import ident, text
from partsnap.operators.diff import NB, NP, SUMMARY_SQL, align, counts_of
from partsnap.operators.profile import lane_sql
from partsnap.operators.volume import status_sql

# Fixed labels of the parts.
VOLUME, PROFILE = "volume", "profile"
COUNTS = (
    "prod_rows", "bkup_rows", "union_distinct", "prod_except_bkup", "bkup_except_prod",
    "prod_only_rows", "bkup_only_rows", "prod_except_all_bkup", "bkup_except_all_prod",
)
DISTINCT = ("prod_distinct", "bkup_distinct")
REPORT_DDL = ", ".join(
    ["part string", "key string", "in_totals boolean", "status string", *[f"{c} bigint" for c in COUNTS], "column string", *[f"{c} bigint" for c in DISTINCT]]
)


def key_label_sql(keys: Sequence[str]) -> str:
    """``k=v/k=v`` of a row's key tuple, for reading only; empty without keys."""
    if not keys:
        return "''"
    return "concat_ws('/', " + ", ".join(f"concat({text(k + '=')}, coalesce(cast({ident(k)} as string), 'null'))" for k in keys) + ")"


def fused_audit(
    prod: DataFrame,
    bkup: DataFrame,
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    totals_of: Column | None = None,
    profile: bool = True,
) -> DataFrame:
    """Rows of :data:`REPORT_DDL`: one of part ``volume`` per key tuple, one of part ``profile`` per column.

    ``totals_of`` (a condition on the keys) marks the partitions that totals and profile
    cover; by default all do.
    """
    p, b, cols = align(prod, bkup, columns)
    counts = counts_of(p, b, cols)
    covered = F.lit(True) if totals_of is None else F.coalesce(totals_of, F.lit(False))
    per_key = counts.groupBy(*[ident(k) for k in keys]).agg(*[F.expr(x) for x in SUMMARY_SQL]).withColumn("in_totals", covered)
    empty_profile = ["cast(null as string) as column", *[f"cast(null as bigint) as {c}" for c in DISTINCT]]
    volume = per_key.selectExpr(f"{text(VOLUME)} as part", f"{key_label_sql(keys)} as key", "in_totals", f"{status_sql()} as status", *COUNTS, *empty_profile)
    if not profile:
        return volume
    types = {f.name: f.dataType for f in counts.schema.fields}
    lanes = [lane_sql(c, types[c]) for c in cols]
    stacked = ", ".join(f"struct({i} as _ps_g, {x} as _ps_i, {y} as _ps_d, {z} as _ps_s)" for i, (x, y, z) in enumerate(lanes))
    pairs = counts.where(covered).selectExpr(f"{NP} > 0 as _ps_p", f"{NB} > 0 as _ps_b", f"inline(array({stacked}))")
    values = pairs.where("_ps_i is not null or _ps_d is not null or _ps_s is not null").groupBy("_ps_g", "_ps_i", "_ps_d", "_ps_s")
    found = values.agg(F.bool_or("_ps_p").alias("p"), F.bool_or("_ps_b").alias("b")).groupBy("_ps_g")
    found = found.agg(F.count_if("p").alias("p"), F.count_if("b").alias("b"))
    # every column has its row, also one that is all NULL
    names = ", ".join(f"{i}, {text(c)}" for i, c in enumerate(cols))
    all_columns = ", ".join(f"struct({i} as _ps_g, 0L as p, 0L as b)" for i in range(len(cols)))
    zeros = prod.sparkSession.range(1).selectExpr(f"inline(array({all_columns}))")
    found = found.unionByName(zeros).groupBy("_ps_g").agg(F.sum("p").alias("p"), F.sum("b").alias("b"))
    return volume.unionByName(
        found.selectExpr(
            f"{text(PROFILE)} as part", "cast(null as string) as key", "true as in_totals", "cast(null as string) as status",
            *[f"cast(null as bigint) as {c}" for c in COUNTS], f"map({names})[_ps_g] as column", "p as prod_distinct", "b as bkup_distinct",
        )
    )
