"""Row counts per partition key, production vs backup.

One ``groupBy`` over the tagged union of both key columns replaces a count
job per partition: partial counts are combined map-side, so a key holding a
third of all rows is one row per task in the shuffle.  A key present on only
one side is reported too (a full outer match, without a join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsnap.functions.rows import ident
from partsnap.operators.diff import align

# Fixed status labels of a volume row.
EQUAL = "equal"
MISSING_IN_BKUP = "missing_in_bkup"
MISSING_IN_PROD = "missing_in_prod"
COUNT_DIFFERS = "count_differs"


def status_sql() -> str:
    """Status of a row with ``prod_rows`` and ``bkup_rows``."""
    return f"""case when prod_rows = bkup_rows then '{EQUAL}'
                    when bkup_rows = 0 then '{MISSING_IN_BKUP}'
                    when prod_rows = 0 then '{MISSING_IN_PROD}'
                    else '{COUNT_DIFFERS}' end"""


def volume_by_partition(prod: DataFrame, bkup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys…, prod_rows, bkup_rows, status`` for every key on either side."""
    p, b, cols = align(prod, bkup, keys)
    names = [ident(c) for c in cols]
    tagged = p.selectExpr(*names, "true as _in_prod").unionByName(b.selectExpr(*names, "false as _in_prod"))
    counts = tagged.groupBy(*names).agg(
        F.expr("count_if(_in_prod) as prod_rows"),
        F.expr("count_if(not _in_prod) as bkup_rows"),
    )
    return counts.selectExpr(
        *names,
        "prod_rows",
        "bkup_rows",
        f"{status_sql()} as status",
    )


def volume_summary(volume: DataFrame) -> DataFrame:
    """One row of tallies over a :func:`volume_by_partition` result."""
    return volume.selectExpr(
        "count_if(prod_rows > 0) as prod_partitions",
        "count_if(bkup_rows > 0) as bkup_partitions",
        "count_if(prod_rows > 0 and bkup_rows > 0) as backed_up_partitions",
        f"count_if(status = '{EQUAL}') as equal_partitions",
        f"count_if(status <> '{EQUAL}') as differing_partitions",
        f"count_if(status = '{MISSING_IN_BKUP}') as missing_in_bkup",
        f"count_if(status = '{MISSING_IN_PROD}') as missing_in_prod",
    )
