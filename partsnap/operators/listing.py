"""The first differing rows of every partition and side, with exact totals beside them.

A diff of two large tables can be as large as a table; a person reads its first
rows.  Here the unmatched rows are ranked where the row-count aggregate left them:
each task keeps its first ``n`` rows of each (side, partition) and only those meet
in the second exchange, so the whole diff is never moved again.  The order is that
of the columns, so two runs list the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from partsnap.functions.rows import BKUP, PROD, SIDE, ident, restored_columns_sql, text
from partsnap.operators.diff import NB, NP, SIDES, align, copies_sql, counts_of

RANK, COPIES, ROWS, DISTINCT = "_rank", "_copies", "_rows", "_distinct"


def diff_listing(
    prod: DataFrame,
    bkup: DataFrame,
    keys: Sequence[str] = (),
    n: int = 10,
    side: str = "both",
    multiset: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``_side, _rank, _copies, _rows, _distinct`` and the columns of the first ``n`` differing rows.

    Rows are ranked within each side and key tuple; a row that repeats is listed once,
    ``_copies`` says how often.  ``_rows`` and ``_distinct`` are the exact numbers of
    differing rows, with and without repeats, of that side and key tuple.  ``side`` and
    ``multiset`` are those of :func:`partsnap.operators.diff.row_diff`.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}, got {side!r}")
    p, b, cols = align(prod, bkup, columns)
    clash = [c for c in cols if c in (RANK, COPIES, ROWS, DISTINCT)]
    if clash:
        raise ValueError(f"columns {clash} clash with report columns; rename them first")
    names = [ident(c) for c in cols]
    wanted = [PROD, BKUP] if side == "both" else [PROD if side == "prod" else BKUP]
    pairs = ", ".join(f"struct({text(s)} as {SIDE}, {copies_sql(s, multiset)} as {COPIES})" for s in wanted)
    unmatched = counts_of(p, b, cols).where(f"{NP} <> {NB}" if multiset else f"({NP} = 0 or {NB} = 0)")
    rows = unmatched.selectExpr(*names, f"inline(array({pairs}))").where(f"{COPIES} > 0")
    group = [SIDE, *[ident(k) for k in keys]]
    totals = rows.groupBy(*group).agg(F.sum(COPIES).alias(ROWS), F.count(F.lit(1)).alias(DISTINCT))
    totals = totals.selectExpr(ROWS, DISTINCT, f"{SIDE} as _ps_side", *[f"{ident(k)} as _ps_k{i}" for i, k in enumerate(keys)])
    order = W.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in names])
    first = rows.withColumn(RANK, F.row_number().over(order)).where(F.col(RANK) <= n)
    same = F.col(SIDE) == F.col("_ps_side")
    for i, k in enumerate(keys):
        same &= F.col(ident(k)).eqNullSafe(F.col(f"_ps_k{i}"))
    return first.join(totals, same).selectExpr(SIDE, RANK, COPIES, ROWS, DISTINCT, *restored_columns_sql(p.schema, cols))
