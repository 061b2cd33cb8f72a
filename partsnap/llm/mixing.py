"""Mixing sources to target weights by Efraimidis-Spirakis sampling (native).

Every source has a target: its weight's share of the words of all documents,
at most ``MAX_EPOCHS`` times the source's own words; the excess goes to the
other sources by weight.  A source below its target is first repeated in
complete epochs; what is left of the target is filled from the documents with
the smallest exponential keys ``-ln(u) / weight`` (u a hash of doc_id, weight
the document's quality), that is, a weighted sample without replacement: of two
documents the one with twice the weight is twice as likely to come first.  By
default the weight is the share of characters that are neither digits nor ASCII
signs, at least ``LEAST_WEIGHT``.

Keys are dealt into slices of equal width of their logarithm, which hold nearly
equal shares whatever the weights are (the density of the logarithm of a key is at
most 1/e for every weight); their number grows with the rows.  Word sums by source
and slice give the prefix sum before each slice, so a window orders only the
documents of one slice of one source, never a whole source.

Defined cases: null text has no words and is never taken; null source is a
source of its own, last in the order; a null doc_id hashes as its text does;
equal keys are ordered by doc_id, then size, and rows that repeat all of these
are exchangeable; an empty table gives an empty result; other columns are
carried through by ``materialise`` and never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, unit_hash, words_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
LEAST_WEIGHT = 0.05
SLICE_ROWS = 20_000  # a slice holds about so many rows of all sources, at least SLICES a factor of two
SLICES = 512


def quality_weight(text: Column) -> Column:
    """Share of the characters that are neither digits nor ASCII signs, at least ``LEAST_WEIGHT`` (1 without characters)."""
    length = F.length(text)
    plain = F.length(F.regexp_replace(text, r"[!-@\[-`{-~]", ""))
    return F.when(F.coalesce(length, F.lit(0)) == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(LEAST_WEIGHT), plain / length))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target words of each row (source, source_size); one row a source.

    Capped sources are those with the smallest cap by weight: with the first j
    of that order at their caps, the others share the rest by weight, and the
    smallest j that leaves none above its cap is the fixed point of resharing.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    s = sizes.withColumn("w", F.get(listed, (F.row_number().over(in_order) - 1) % len(weights)))
    s = s.withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap") / F.col("w"))
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.partitionBy()
    s = s.withColumn("all_words", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    before_cap = F.sum("cap").over(upto) - F.col("cap")
    before_w = F.sum("w").over(upto) - F.col("w")
    s = s.withColumn("level", (F.col("all_words") - before_cap) / (F.col("all_w") - before_w))
    # the first source of this order that does not reach its cap sets the level
    s = s.withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    return s.select(
        "source", "source_size",
        F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap").cast("double"))
        .otherwise(F.col("level") * F.col("w")).alias("target"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    quality: Column | None = None,
    split_last: bool = True,
    slices: int = SLICES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, epochs, extra and taken words of every row.

    ``epochs`` full copies and ``extra`` more words of the document are taken.
    With ``split_last`` the document that crosses the budget gives only the
    words that are left, else it is taken whole if that comes nearer.
    ``keep`` names further columns of ``docs`` to carry along.
    """
    size = words_of(F.col(text))
    weight = quality if quality is not None else quality_weight(F.col(text))
    u = unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    base = cut(docs.select("doc_id", "source", *keep, size.alias("size"), (-F.log(u) / weight).alias("_key")))
    # most keys lie within eight factors of two
    per_octave = max(slices, -(-base.count() // (8 * SLICE_ROWS)))
    base = base.withColumn("_slice", F.floor(F.log2("_key") * per_octave).cast("long"))

    by_slice = base.groupBy("source", "_slice").agg(F.sum("size").alias("words"))
    along = W.partitionBy("source").orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    by_slice = by_slice.withColumn("before", F.sum("words").over(along) - F.col("words"))
    goals = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    g, b = goals.alias("g"), by_slice.alias("b")
    plan = b.join(g, F.col("b.source").eqNullSafe(F.col("g.source"))).select(
        F.col("b.source").alias("_source"), F.col("b._slice").alias("_of"), "before", "source_size", "target",
    )
    whole = F.round("target").cast("long")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", whole - F.col("epochs") * F.col("source_size"))

    joined = base.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_of")))
    inside = W.partitionBy("_source", "_of").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    left = F.col("rest") - F.col("before") - (F.sum("size").over(inside) - F.col("size"))
    if split_last:
        extra = F.greatest(F.lit(0), F.least(left, F.col("size")))
    else:
        extra = F.when((left > 0) & (2 * left >= F.col("size")), F.col("size")).otherwise(F.lit(0))
    joined = joined.withColumn("extra", extra.cast("long"))
    return joined.select(
        "doc_id", "source", *keep, "size", "source_size", "target", "epochs", "extra",
        (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
    )


def materialise(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each row as often as it is taken, whole, with the columns of ``docs``."""
    columns = docs.columns
    keep = [c for c in columns if c not in ("doc_id", "source")]
    renamed = docs.select("doc_id", "source", *[F.col(c).alias(f"_in_{c}") for c in keep])
    taken = mix(renamed, text="_in_text", keep=[f"_in_{c}" for c in keep], split_last=False, **options)
    copies = F.col("epochs") + (F.col("extra") > 0).cast("long")
    rows = taken.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return rows.select(*[F.col(c if c in ("doc_id", "source") else f"_in_{c}").alias(c) for c in columns])
