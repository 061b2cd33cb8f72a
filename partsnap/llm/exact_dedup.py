"""Exact dedup by a tree merge of sorted digest runs (native).

Every input partition makes a run: its distinct digests in order, each with the
smallest document and the number of rows.  In binomial rounds pairs of runs merge
(``fan_in`` runs, in general): the entries of runs r with the same ``r // fan_in``
meet by digest range, are put in order there, and one pass over them makes equal
digests one entry that keeps the smallest identifier.  A run stays cut into
``RANGES`` ranges of the digest, each in its own place, so no round gathers a run,
let alone the root, in one task; a digest has one entry a run, however many rows
share it.  The root's answer goes back to the entries of the first runs and from
there to the rows by (run, digest), so a text that a third of all rows share is
spread over all runs.

Two rows are equal if SHA-256, byte length and a second 64-bit hash of the
normalised text agree (white space runs ``[\\x20\\x09-\\x0D]+`` become one
space); entries merge only if all three do, at every level.

Defined cases: null text is empty, and empty texts equal each other; a null
doc_id comes after all others; rows that repeat doc_id and text form a group
of which one row stays; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WHITE, cut

FAN_IN = 2
RANGES = 256
DIGEST = ("sha", "n_bytes", "second")


def digests(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, run (input partition) and the digests of the normalised text."""
    plain = docs.select("doc_id", *keep, F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ").alias("_t"))
    return plain.select(
        "doc_id", *keep, F.spark_partition_id().alias("run"), F.unhex(F.sha2("_t", 256)).alias("sha"),
        F.octet_length("_t").alias("n_bytes"), F.xxhash64("_t").alias("second"),
    )


def merged(entries: DataFrame) -> DataFrame:
    """One pass over entries that are in order by run, range and digest: equal ones become one."""
    return entries.groupBy("run", "range", *DIGEST).agg(F.min("best").alias("best"), F.sum("n_rows").alias("n_rows"))


def merge_rounds(base: DataFrame, fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """Entries of the first runs, and of the root: digest, smallest (null, doc_id, run), rows."""
    order = ("run", "range", *DIGEST)
    place = F.conv(F.hex(F.substring("sha", 1, 1)), 16, 10).cast("int") % RANGES
    rows = base.withColumns({
        "range": place, "n_rows": F.lit(1).cast("long"),
        "best": F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("run").alias("in_run")),
    })
    first = cut(merged(rows).sortWithinPartitions(*order))
    runs = (first.agg(F.max("run")).first()[0] or 0) + 1
    level = first
    while runs > 1:
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        # the ranges of the runs that meet, in order: equal digests are neighbours and no further exchange is needed
        level = merged(level.repartition("run", "range").sortWithinPartitions(*order))
        runs = -(-runs // fan_in)
    return first, level


def exact_dedup(docs: DataFrame, fan_in: int = FAN_IN, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, plus the columns in ``keep``."""
    base = cut(digests(docs, keep))
    first, root = merge_rounds(base, fan_in)
    answer = root.select(*DIGEST, F.col("best").alias("winner"), F.col("n_rows").alias("group_size"))
    by_run = first.select("run", *DIGEST).join(answer, list(DIGEST))
    rows = base.join(by_run, ["run", *DIGEST])
    repeat = F.row_number().over(W.partitionBy("run", *DIGEST, "doc_id").orderBy("doc_id"))
    rows = rows.withColumn("_n", repeat)
    return rows.select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("run") == F.col("winner.in_run")) & (F.col("_n") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), *keep,
    )


def survivors(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    columns = docs.columns
    renamed = docs.select("doc_id", "text", *[F.col(c).alias(f"_in_{c}") for c in columns if c not in ("doc_id", "text")])
    wanted = exact_dedup(renamed, fan_in, keep=tuple(c for c in renamed.columns if c != "doc_id"))
    back = [F.col(c if c in ("doc_id", "text") else f"_in_{c}").alias(c) for c in columns]
    return wanted.where("kept").select(*back)
