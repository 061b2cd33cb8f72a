"""Rendezvous hashing of record keys over weighted shards (native).

A record goes to the shard with the smallest exponential ``-ln(u) / weight``,
where u hashes (doc_id, shard): the winner of a weighted race that looks at no
other record.  A further shard only takes the records that it wins.

Slots number the records of a shard in the order of a hash of doc_id.  The
order is cut into slices by the leading hex digits of that hash, as many as
keep a slice small; counts by (shard, slice) give the first slot of each
slice, so windows order single slices.  The numbers do not depend on the cut.

Defined cases: null text has size ``OVERHEAD`` and the CRC of an empty text;
null doc_id is the key "", so such rows share a shard; rows that repeat a
doc_id share a shard and have slots of their own, in order of CRC and size;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

SHARDS = 40
OVERHEAD = 16
SLICE_ROWS = 2000


def race(key: Column, shard: Column, weights: Column) -> Column:
    """Time of ``shard`` in the race for ``key``: exponential with the shard's weight as its rate."""
    digest = F.md5(F.concat_ws(":", key, shard.cast("string")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / F.get(weights, shard)


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among ``len(weights)`` shards, with its time: struct(time, shard)."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    entries = F.transform(
        F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda j: F.struct(race(key, j, listed).alias("time"), j.alias("shard"))
    )
    return F.array_min(entries)


def shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, added: float = 1.0, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one more shard of weight ``added``)."""
    n = len(weights)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("_key"),
    )
    base = base.withColumn("_won", winner(F.col("_key"), weights)).withColumn("_hash", F.md5("_key"))
    late = race(F.col("_key"), F.lit(n), F.array(*[F.lit(float(added))] * (n + 1)))
    base = cut(
        base.select(
            "doc_id", "size", "text_crc32", "_hash", F.col("_won.shard").alias("shard"),
            F.when(late < F.col("_won.time"), F.lit(n)).otherwise(F.col("_won.shard")).alias("grown_shard"),
        )
    )
    digits = max(0, math.ceil(math.log(max(1, base.count()) / (n * slice_rows), 16)))
    base = base.withColumn("_slice", F.substring("_hash", 1, digits))
    counts = base.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("rows"))
    along = W.partitionBy("shard").orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = counts.select("shard", "_slice", (F.sum("rows").over(along) - F.col("rows")).alias("first"))
    inside = W.partitionBy("shard", "_slice").orderBy("_hash", "doc_id", "text_crc32", "size")
    placed = base.join(first, ["shard", "_slice"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first") + F.row_number().over(inside) - 1).alias("slot"), "grown_shard",
    )
