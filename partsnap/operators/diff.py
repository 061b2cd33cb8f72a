"""Row-level differences between a production table and its backup.

Every result here comes from one aggregate: both sides are tagged, unioned,
and grouped by all their columns (maps made comparable first).  Spark combines the
groups map-side before the shuffle, so a value repeated in a third of all
rows costs one row per map task on the wire, and there is no join, hence no
join-key skew and no N-column null-safe join condition.

From the per-row counts ``_np`` (copies in prod) and ``_nb`` (copies in the
backup):

* row diff, prod side (the default): ``_np`` copies where ``_nb = 0``;
* multiset diff (``EXCEPT ALL``): ``greatest(_np - _nb, 0)`` copies;
* ``EXCEPT`` (distinct): one row where ``_nb = 0``;
* union-distinct count: number of groups.

Rows that must be emitted many times are cut into chunks of at most
``COPY_CHUNK`` copies and the chunks are hash-spread over the shuffle
partitions before they are expanded, so no task emits a hot group alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsnap.functions.rows import (
    BKUP,
    PROD,
    SIDE,
    comparable_columns_sql,
    ident,
    restored_columns_sql,
    text,
)

NP = "_np"
NB = "_nb"
COPY_CHUNK = 1 << 16
SIDES = ("prod", "bkup", "both")
RESERVED = (SIDE, NP, NB)


def shared_columns(prod: DataFrame, bkup: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Columns (in prod's spelling) of both sides, of prod only and (in its spelling) of the backup only.

    Names meet as Spark resolves them, without regard to case unless
    ``spark.sql.caseSensitive`` is set.
    """
    exact = prod.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    norm = (lambda c: c) if exact else str.lower
    theirs, mine = {norm(c) for c in bkup.columns}, {norm(c) for c in prod.columns}
    both = [c for c in prod.columns if norm(c) in theirs]
    return both, [c for c in prod.columns if norm(c) not in theirs], [c for c in bkup.columns if norm(c) not in mine]


def align(prod: DataFrame, bkup: DataFrame, columns: Sequence[str] | None = None):
    """Both sides projected on the same columns, by name, in prod order.

    Without ``columns`` the sides must have the same columns: one-sided ones
    raise, as leaving them out would hide a difference.  A column whose type
    differs between the sides (a key kept as text in the backup, for instance)
    is compared as text on both sides.
    """
    both, prod_only, bkup_only = shared_columns(prod, bkup)
    if columns:
        cols = list(columns)
        missing = [c for c in cols if c not in both]
        if missing:
            raise ValueError(f"columns missing in prod or backup: {missing}")
    else:
        cols = both
        if prod_only or bkup_only:
            raise ValueError(f"columns missing in backup: {prod_only}; columns missing in prod: {bkup_only}; name the columns to compare")
    clash = [c for c in cols if c in RESERVED]
    if clash:
        raise ValueError(f"columns {clash} clash with report columns {RESERVED}; rename them first")
    pt = {c: prod.select(ident(c)).schema[0].dataType for c in cols}
    bt = {c: bkup.select(ident(c)).schema[0].dataType for c in cols}
    exprs = [f"{ident(c)} as {ident(c)}" if pt[c] == bt[c] else f"cast({ident(c)} as string) as {ident(c)}" for c in cols]
    return prod.selectExpr(*exprs), bkup.selectExpr(*exprs), cols


def row_counts(prod: DataFrame, bkup: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct row value of prod ∪ backup: the columns, ``_np``, ``_nb``.

    Map columns come out as sorted entry arrays (see :func:`restored_columns_sql`).
    """
    return counts_of(*align(prod, bkup, columns))


def counts_of(p: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """:func:`row_counts` of aligned sides."""
    tagged = p.selectExpr(*comparable_columns_sql(p.schema, cols), "true as _ps_in").union(
        b.selectExpr(*comparable_columns_sql(b.schema, cols), "false as _ps_in")
    )
    return tagged.groupBy(*[ident(c) for c in cols]).agg(
        F.expr(f"count_if(_ps_in) as {NP}"),
        F.expr(f"count_if(not _ps_in) as {NB}"),
    )


def copies_sql(side: str, multiset: bool) -> str:
    """How often a row of the counts is reported for ``side``."""
    mine, other = (NP, NB) if side == PROD else (NB, NP)
    if multiset:
        return f"greatest({mine} - {other}, 0L)"
    return f"if({other} = 0, {mine}, 0L)"


def expand_copies(
    df: DataFrame, n: str, chunk: int = COPY_CHUNK, min_chunk: int = 1024
) -> DataFrame:
    """Emit each row ``df[n]`` times, spreading large multiplicities over tasks.

    A row is cut into chunks of at most ``chunk`` copies, sized so that a row
    with many copies yields about four chunks per shuffle partition (never
    below ``min_chunk`` copies); the chunk rows are hash-partitioned by
    (row, chunk) over ``spark.sql.shuffle.partitions`` (a fixed count, so AQE
    cannot fold a hot row's chunks back into one task); each task then
    expands only its own chunks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keep = [ident(c) for c in df.columns if c != n]
    k = ident(n)
    size = f"least({chunk}L, greatest({min(min_chunk, chunk)}L, cast(ceil({k} / {4 * parts}.0D) as bigint)))"
    chunks = df.where(f"{k} > 0").selectExpr(*keep, k, f"{size} as _ps_s").selectExpr(
        *keep, k, "_ps_s", f"explode(sequence(0L, cast(floor(({k} - 1) / _ps_s) as bigint))) as _ps_c"
    )
    spread = chunks.selectExpr(*keep, f"least(_ps_s, {k} - _ps_c * _ps_s) as _ps_k", "_ps_c")
    spread = spread.repartition(parts, *keep, "_ps_c")
    return spread.selectExpr(*keep, "explode(array_repeat(0, cast(_ps_k as int))) as _ps_x").drop("_ps_x")


def _total(expr: str, name: str) -> str:
    return f"cast(coalesce(sum({expr}), 0) as bigint) as {name}"


# The totals of :func:`differential_summary`, as aggregates over the per-row counts.
SUMMARY_SQL = (
    _total(NP, "prod_rows"),
    _total(NB, "bkup_rows"),
    "count(1) as union_distinct",
    f"count_if({NP} > 0 and {NB} = 0) as prod_except_bkup",
    f"count_if({NB} > 0 and {NP} = 0) as bkup_except_prod",
    _total(copies_sql(PROD, False), "prod_only_rows"),
    _total(copies_sql(BKUP, False), "bkup_only_rows"),
    _total(copies_sql(PROD, True), "prod_except_all_bkup"),
    _total(copies_sql(BKUP, True), "bkup_except_all_prod"),
)


def row_diff(
    prod: DataFrame,
    bkup: DataFrame,
    side: str = "both",
    multiset: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows present on one side and not on the other, tagged with ``_side``.

    ``side`` is ``prod`` (rows of prod missing from the backup), ``bkup``
    (the reverse) or ``both``.  By default a row is reported with all its
    copies when no equal row exists on the other side (NULLs compare equal to
    NULLs, never to the text ``'null'``).  ``multiset=True`` reports the
    surplus copies instead (``EXCEPT ALL``).
    """
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}, got {side!r}")
    p, b, cols = align(prod, bkup, columns)
    counts = counts_of(p, b, cols)
    # Rows present on both sides (the bulk, for a good backup) leave right after the aggregate.
    unmatched = f"{NP} <> {NB}" if multiset else f"({NP} = 0 or {NB} = 0)"
    counts = counts.where(unmatched)
    names = [ident(c) for c in cols]
    wanted = [PROD, BKUP] if side == "both" else [PROD if side == "prod" else BKUP]
    if len(wanted) == 1:
        tagged = counts.selectExpr(*names, f"{text(wanted[0])} as {SIDE}", f"{copies_sql(wanted[0], multiset)} as _ps_n")
    else:
        pairs = ", ".join(f"struct({text(s)} as {SIDE}, {copies_sql(s, multiset)} as _ps_n)" for s in wanted)
        tagged = counts.selectExpr(*names, f"inline(array({pairs}))")
    rows = expand_copies(tagged, "_ps_n")
    return rows.selectExpr(SIDE, *restored_columns_sql(p.schema, cols))


def except_distinct(prod: DataFrame, bkup: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of prod with no equal row in the backup (``EXCEPT``)."""
    p, b, cols = align(prod, bkup, columns)
    counts = counts_of(p, b, cols)
    return counts.where(f"{NP} > 0 and {NB} = 0").selectExpr(*restored_columns_sql(p.schema, cols))


def union_distinct(prod: DataFrame, bkup: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of prod ∪ backup (``UNION``)."""
    p, b, cols = align(prod, bkup, columns)
    return counts_of(p, b, cols).selectExpr(*restored_columns_sql(p.schema, cols))


def differential_summary(prod: DataFrame, bkup: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of totals, all from the same aggregate (one shuffle).

    ``prod_rows``, ``bkup_rows``, ``union_distinct``; ``prod_except_bkup`` and
    ``bkup_except_prod`` (distinct rows, ``EXCEPT``); ``prod_only_rows`` and
    ``bkup_only_rows`` (row diff, with copies); ``prod_except_all_bkup`` and
    ``bkup_except_all_prod`` (``EXCEPT ALL``).
    """
    return row_counts(prod, bkup, columns).selectExpr(*SUMMARY_SQL)
