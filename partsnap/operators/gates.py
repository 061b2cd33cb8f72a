"""Row-count gates: should a load run at all?

A gate compares two counts and answers ``should_load`` (the counts differ).
Counts are taken from partition-pruned scans: the newest key is looked up
first (one key tuple on the driver), then both counts come out of one
aggregate over the union of the two filtered sides, so a gate on a 100 TB
table reads one partition per side.

* :func:`latest_count` compares the newest prod partition with the newest
  backup partition, even when their keys differ (the historical behaviour:
  a new day of the same size as yesterday is skipped);
* :func:`same_key_count` compares prod's newest partition with the backup
  partition of the same key (absent = 0 rows), the safe default;
* :func:`full_count` compares whole-table counts, for unpartitioned tables.

Equal counts are taken as equal content; the row diff is the content check.

Two plans, by what is known about the inputs:

* with key listings (``prod_keys`` / ``bkup_keys``, e.g. the catalog's
  partition list), the newest key is looked up first and the counts are
  taken from scans pruned to that partition;
* without them (plain DataFrames), the gate is read off the per-key volume
  table in one lazy job: each side is scanned once, counted per key with
  map-side partial aggregation, and the newest key is a ``max`` over the
  key tuples (NULL keys sort first, so they are the oldest).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsnap.functions.keys import key_in
from partsnap.functions.rows import ident
from partsnap.operators.fingerprint import partition_fingerprints
from partsnap.operators.volume import volume_by_partition
from partsnap.sources.partitions import listing, newest_keys



def _two_counts(prod_rows: DataFrame, bkup_rows: DataFrame | None) -> DataFrame:
    tagged = prod_rows.select(F.lit(True).alias("_in_prod"))
    if bkup_rows is not None:
        tagged = tagged.unionByName(bkup_rows.select(F.lit(False).alias("_in_prod")))
    return tagged.agg(
        F.count_if(F.col("_in_prod")).alias("prod_rows"),
        F.count_if(~F.col("_in_prod")).alias("bkup_rows"),
    )


def _key_literals(df: DataFrame, keys: Sequence[str], row, prefix: str = "") -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.lit(None if row is None else row[k]).cast(types[k]).alias(f"{prefix}{k}") for k in keys
    ]


def _decide(has_source: bool) -> Column:
    differs = F.col("prod_rows") != F.col("bkup_rows")
    return (differs if has_source else F.lit(False)).alias("should_load")


def _key_struct(keys: Sequence[str], **fields: str) -> str:
    """Key tuple first (so ``max`` orders by it), then the named payload fields."""
    parts = [f"{ident(k)} as {ident(k)}" for k in keys] + [f"{v} as {n}" for n, v in fields.items()]
    return "struct(" + ", ".join(parts) + ")"


def latest_count(
    prod: DataFrame,
    bkup: DataFrame,
    keys: Sequence[str],
    prod_keys: DataFrame | None = None,
    bkup_keys: DataFrame | None = None,
) -> DataFrame:
    """``prod_<key>, bkup_<key>, prod_rows, bkup_rows, should_load`` (one row)."""
    if prod_keys is None or bkup_keys is None:
        per_key = volume_by_partition(prod, bkup, keys)
        newest = per_key.selectExpr(
            f"max(if(prod_rows > 0, {_key_struct(keys, _rows='prod_rows')}, null)) as _p",
            f"max(if(bkup_rows > 0, {_key_struct(keys, _rows='bkup_rows')}, null)) as _b",
        )
        return newest.selectExpr(
            *[f"_p.{ident(k)} as {ident('prod_' + k)}" for k in keys],
            *[f"_b.{ident(k)} as {ident('bkup_' + k)}" for k in keys],
            "coalesce(_p._rows, 0L) as prod_rows",
            "coalesce(_b._rows, 0L) as bkup_rows",
            "_p is not null and coalesce(_p._rows, 0L) <> coalesce(_b._rows, 0L) as should_load",
        )
    pk = newest_keys(prod_keys, keys, 1)
    bk = newest_keys(bkup_keys, keys, 1)
    p = prod.where(key_in(keys, pk)) if pk else prod.limit(0)
    b = bkup.where(key_in(keys, bk)) if bk else bkup.limit(0)
    counts = _two_counts(p, b)
    return counts.select(
        *_key_literals(prod, keys, pk[0] if pk else None, "prod_"),
        *_key_literals(bkup, keys, bk[0] if bk else None, "bkup_"),
        "prod_rows",
        "bkup_rows",
        _decide(bool(pk)),
    )


def same_key_count(
    prod: DataFrame,
    bkup: DataFrame | None,
    keys: Sequence[str],
    prod_keys: DataFrame | None = None,
) -> DataFrame:
    """``<key>…, prod_rows, bkup_rows, should_load`` for prod's newest key.

    One row; none when prod has no rows and no listing is given.
    """
    if prod_keys is None and bkup is not None:
        per_key = volume_by_partition(prod, bkup, keys).where("prod_rows > 0")
        top = per_key.selectExpr(f"max({_key_struct(keys, _rows='prod_rows', _other='bkup_rows')}) as _t")
        return top.where("_t is not null").selectExpr(
            *[f"_t.{ident(k)} as {ident(k)}" for k in keys],
            "_t._rows as prod_rows",
            "_t._other as bkup_rows",
            "_t._rows <> _t._other as should_load",
        )
    if prod_keys is None:
        prod_keys = prod.select(*keys).distinct()
    pk = newest_keys(prod_keys, keys, 1)
    p = prod.where(key_in(keys, pk)) if pk else prod.limit(0)
    b = None
    if bkup is not None:
        b = bkup.where(key_in(keys, pk)) if pk else bkup.limit(0)
    counts = _two_counts(p, b)
    return counts.select(
        *_key_literals(prod, keys, pk[0] if pk else None),
        "prod_rows",
        "bkup_rows",
        _decide(bool(pk)),
    )


def same_key_content(
    prod: DataFrame,
    bkup: DataFrame,
    keys: Sequence[str],
    prod_keys: DataFrame | None = None,
) -> DataFrame:
    """``<key>…, prod_rows, bkup_rows, should_load`` for prod's newest key, by content.

    Like :func:`same_key_count`, but a backup partition with the right count
    and other rows is loaded too: both sides of that one partition are
    reduced to fingerprints (count and two 64-bit row-hash sums, see
    :mod:`partsnap.operators.fingerprint`).  It reads the partition's data on
    both sides, where a count reads only metadata.  One row.
    """
    pk = newest_keys(prod_keys if prod_keys is not None else listing(prod, keys), keys, 1)
    p = prod.where(key_in(keys, pk)) if pk else prod.limit(0)
    b = bkup.where(key_in(keys, pk)) if pk else bkup.limit(0)
    fp = partition_fingerprints(p, b, keys).agg(
        F.coalesce(F.max("prod_rows"), F.lit(0)).alias("prod_rows"),
        F.coalesce(F.max("bkup_rows"), F.lit(0)).alias("bkup_rows"),
        F.coalesce(F.max("changed"), F.lit(False)).alias("should_load"),
    )
    return fp.select(*_key_literals(prod, keys, pk[0] if pk else None), "prod_rows", "bkup_rows", "should_load")


def full_count(prod: DataFrame, bkup: DataFrame | None) -> DataFrame:
    """``prod_rows, bkup_rows, should_load`` over whole tables (one row)."""
    return _two_counts(prod, bkup).select("prod_rows", "bkup_rows", _decide(True))
