"""Near-duplicate documents by circulant MinHash, with exact verification.

A document's set holds its distinct shingles of three lower-cased words (A-Z
only).  Circulant MinHash needs two permutations of the 64-bit universe: the
first one scatters the shingles, and coordinate k of the signature is the
smallest value of the second one, circularly shifted by k steps.  Bands of
``ROWS`` coordinates that agree make two documents candidates; at a similarity
of 0.85 a pair is missed by all ``BANDS`` bands with probability
``(1 - 0.85**ROWS)**BANDS``, about 2e-7.  Links are confirmed on the full sets.

Large groups never yield all their pairs:

1. Documents with equal sets form a class that its smallest doc_id stands for.
2. In every bucket of a band each class is compared with one hub, the member
   that meets most others in its buckets, so that copies with few edits come
   first.  This gives links, and the size of each member's overlap with its hub.
3. Members similar to a hub (0.5 or more) are described by what sets them
   apart from the group's consensus C, the shingles of more than half of them:
   m missing and v novel ones.  As two of them share at least |C| - m - m'
   shingles, all links that this already proves run through the member with
   the least 185 m + 85 n, so one link to it stands for them.
4. Classes that are still in other components than most of a hub's members are
   strays.  To be linked to a member of another component, a stray must have
   k of its missing or novel shingles in common with it, k following from both
   sizes; with these shingles in one order, rarest first, one of the common
   ones is among all but the last k - 1 of each (prefix filter).  So a stray
   meets only members with such a rare shingle.
5. A member not similar to its hub (less than 0.5) can only be linked to a
   member at less than 0.65 of this hub, as 1 - similarity is a metric.  Such
   members go through a prefix filter on their full sets: linked sets of n <= m
   shingles, rarest first, have their first common one among the first
   n - ceil(170 n / 185) + 1 of the smaller and m - ceil(0.85 m) + 1 of the
   larger set, and enough shingles after it.  Documents of one template, each
   with words of its own, so meet nobody.  Pairs of 4 and 5 are compared.

What one hub, bucket or shingle holds never goes to one task: keys with more
rows than an even task would get (``hot_keys``, fewer than there are shuffle
partitions) are spread over ``SPREAD`` places, and what is joined to them is
copied there.

Each candidate pair is thus compared, known to be connected, or proven not to
be a link.

Defined cases: null, empty and word-less texts have an empty set, link with
nothing and are kept; texts of one or two words are one shingle; rows that
repeat a doc_id and text share a component (and are all kept if the doc_id is
its smallest); rows of one doc_id with different texts go by their own sets,
except that a link counts if any of these texts confirms it; a null doc_id
takes no part, has no component and is kept; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .textops import U, Words, mix, numbers, slices

SHINGLE = 3
THRESHOLD = 85  # percent
BANDS, ROWS = 33, 6
CHUNK = 1 << 19
SPREAD = 64


def cut(df: DataFrame) -> DataFrame:
    """Many rounds of shuffles follow each other, so each one's files go at once."""
    return common.cut(df, drop_shuffles=True)


def shingle_hashes(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of texts whose words have hashes ``h``, and each text's first one.

    ``first`` are the texts' first words (one more at the end).  A text of
    fewer than ``width`` words has one shingle of all its words.
    """
    n = np.diff(first)
    parts = numbers(23, width + 1) | U(1)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    out_first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(n)), count)
    at = np.arange(out_first[-1]) - out_first[owner] + first[owner]
    length = np.minimum(n[owner], width)
    x = length.astype(U) * parts[width]
    for j in range(width):
        inside = j < length
        x[inside] += h[at[inside] + j] * parts[j]
    return mix(x), out_first


def sets_of(column: pa.Array, words: Words, width: int = SHINGLE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each text) for runs of texts."""
    for i, _, buf, offsets in slices(column, CHUNK):
        starts, ends, first = words.bounds(buf, offsets)
        x, at = shingle_hashes(words.hashes(buf, starts, ends), first, width)
        yield i, [np.unique(x[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def signatures(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band hashes (len(sets), bands) of non-empty sets by circulant MinHash."""
    sizes = np.array([len(s) for s in sets])
    first = np.cumsum(sizes) - sizes
    scattered = mix(np.concatenate(sets) ^ numbers(31, 1)[0])  # the first permutation
    a, b, step, *weights = numbers(37, 3 + rows) | U(1)
    out = np.zeros((len(sets), bands), U)
    y = np.empty_like(scattered)
    t = np.empty_like(scattered)
    shift = U(0)
    with np.errstate(over="ignore"):
        for k in range(bands * rows):
            np.add(scattered, shift, out=y)  # the shift; then the second permutation
            y *= a
            np.right_shift(y, U(32), out=t)
            y ^= t
            y *= b
            out[:, k // rows] += np.minimum.reduceat(y, first) * weights[k % rows]
            shift += step
        out += np.arange(bands, dtype=U) * weights[0]
    return mix(out)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set and band hashes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            n, digest, bands = [], [], []
            for _, sets in sets_of(batch.column("text"), words):
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full)) if full else iter(())
                n += [len(s) for s in sets]
                digest += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                bands += [next(sig).view(np.int64) if len(s) else None for s in sets]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "bands"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Set sizes and overlap of the pairs (h, x), and, if they are similar, the shingles that x adds and lacks.

    ``texts`` are (id, text) rows.
    """
    left = pairs.select("h", "x").join(texts.select(F.col("id").alias("h"), F.col("text").alias("th")), "h")
    both = left.join(texts.select(F.col("id").alias("x"), F.col("text").alias("tx")), "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            n_h, n_x, common, novel, missing = [], [], [], [], []
            for hs, xs in zip_slices(batch.column("th"), batch.column("tx"), words):
                for h, x in zip(hs, xs, strict=True):
                    at = np.searchsorted(h, x)
                    inside = h[np.minimum(at, len(h) - 1)] == x if len(h) else np.zeros(len(x), bool)
                    c = int(inside.sum())
                    n_h.append(len(h))
                    n_x.append(len(x))
                    common.append(c)
                    alike = 3 * c >= len(h) + len(x)
                    novel.append(x[~inside].view(np.int64) if alike else None)
                    missing.append(np.delete(h, at[inside]).view(np.int64) if alike else None)
            columns = [batch.column("h"), batch.column("x"), *[pa.array(v, pa.int64()) for v in (n_h, n_x, common)], *[pa.array(v, pa.list_(pa.int64())) for v in (novel, missing)]]
            yield pa.record_batch(columns, ["h", "x", "n_h", "n", "a", "novel", "missing"])

    return both.select("h", "x", "th", "tx").mapInArrow(run, "h long, x long, n_h long, n long, a long, novel array<long>, missing array<long>")


def linked(common, m, n):
    """Similarity of sets of m and n members of which ``common`` are shared: at least THRESHOLD percent."""
    return (100 + THRESHOLD) * common >= THRESHOLD * (m + n)


def zip_slices(left: pa.Array, right: pa.Array, words: Words):
    """Sets of both columns, some rows at a time."""
    for i in range(0, len(left), 64):
        xs = [s for _, part in sets_of(left.slice(i, 64), words) for s in part]
        ys = [s for _, part in sets_of(right.slice(i, 64), words) for s in part]
        yield xs, ys


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b).

    Labels pass along links and are then looked up once more (pointer
    jumping), so long chains shorten by half each round; a round that changes
    nothing ends it.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        seen = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(seen, labels["id"] == seen["a"]).select("id", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        up = labels.select(F.col("id").alias("to"), F.col("component").alias("up"))
        jumped = step.join(up, "to").select("id", "old", F.least("to", "up").alias("component"))
        jumped = cut(jumped)
        changed = jumped.where(F.col("old") != F.col("component")).limit(1).count()
        labels = jumped.select("id", "component")
        if not changed:
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) after further links (a, b), by the components that these connect."""
    def of(end: str) -> DataFrame:
        return labels.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))

    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    across = cut(ends.where("a <> b").distinct())
    if across.isEmpty():
        return labels
    top = components(across)
    moved = labels.join(top.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    moved = moved.select("id", F.coalesce("to", "component").alias("component"))
    return cut(moved.unionAll(top.join(labels, "id", "left_anti")))


def hot_keys(counts: DataFrame, key: str, count: str) -> list[int]:
    """Keys with more rows than an even task would get, so fewer of them than shuffle partitions; ``counts`` has a row a key."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [r[0] for r in counts.where(F.col(count) * tasks > total).select(key).collect()]


def beside(rows: DataFrame, facts: DataFrame, key: str, hot: list[int], by: str = "x", how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row of ``facts`` for their key; the rows of hot keys are spread by the column ``by``."""
    is_hot = F.expr(f"`{key}` in ({', '.join(map(str, hot))})") if hot else F.lit(False)
    spread = rows.withColumn("_place", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SPREAD)).cast("int")).otherwise(0))
    places = F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    return spread.join(facts.withColumn("_place", F.explode(places)), [key, "_place"], how).drop("_place")


def with_components(rows: DataFrame, labels: DataFrame, hot: list[int]) -> DataFrame:
    """``rows`` of (h, x, ...) with the component of x, for hubs that see more than one, and the hub's main one."""
    of = labels.select(F.col("id").alias("x"), "component")
    known = rows.drop("component", "main").join(of, "x", "left").withColumn("component", F.coalesce("component", "x"))
    sizes = known.groupBy("h", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("h").agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return beside(known, main.select("h", F.col("top.component").alias("main")), "h", hot)


def against_consensus(close: DataFrame, hot: list[int]) -> DataFrame:
    """(h, x, n, m, v, c, f, apart): each member's distance from its group's consensus.

    ``close`` are (h, x, n, n_h, novel, missing), two members or more a hub.
    ``apart`` are the shingles missing or novel against the consensus, m and v
    their numbers, c the size of the consensus and f = 185 m + 85 n.
    """
    size = close.groupBy("h").agg(F.count(F.lit(1)).alias("members"))

    def common(column: str) -> DataFrame:
        counts = close.select("h", F.explode(column).alias("s")).groupBy("h", "s").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        often = beside(counts, size, "h", hot, by="s").where(2 * F.col("k") > F.col("members"))
        return often.groupBy("h").agg(F.collect_list("s").alias(f"all_{column}"))

    none = F.expr("cast(array() as array<long>)")
    rows = beside(beside(close, common("novel"), "h", hot, how="left"), common("missing"), "h", hot, how="left")
    rows = rows.withColumns({c: F.coalesce(c, none) for c in ("all_novel", "all_missing")})
    novel = F.concat(F.array_except("novel", "all_novel"), F.array_except("all_missing", "missing"))
    missing = F.concat(F.array_except("missing", "all_missing"), F.array_except("all_novel", "novel"))
    rows = rows.withColumns({"_novel": novel, "_missing": missing})
    rows = rows.withColumns({
        "m": F.size("_missing"), "v": F.size("_novel"), "c": F.col("n_h") - F.size("all_missing") + F.size("all_novel"),
        "apart": F.concat("_novel", "_missing"),
    })
    return rows.withColumn("f", (100 + THRESHOLD) * F.col("m") + THRESHOLD * F.col("n")).select("h", "x", "n", "m", "v", "c", "f", "apart")


def central_links(members: DataFrame, hot: list[int]) -> DataFrame:
    """Links (a, b) to each group's member of least f that the distances from the consensus prove."""
    center = members.groupBy("h").agg(F.min(F.struct("f", "x")).alias("center"))
    sure = F.col("f") + F.col("center.f") <= (100 + THRESHOLD) * F.col("c")
    return beside(members, center, "h", hot).where(sure & (F.col("x") != F.col("center.x"))).select(F.col("center.x").alias("a"), F.col("x").alias("b"))


def rarest_first(tokens: DataFrame, owner: list[str]) -> DataFrame:
    """Tokens t that several owners have, with their place ``nth`` among their owner's ``size`` tokens in order of rarity."""
    shared = cut(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    along = W.partitionBy(*owner)
    alone = F.col("size") - F.count(F.lit(1)).over(along)  # these come first
    return beside(tokens, shared, "t", hot_keys(shared, "t", "k")).withColumn("nth", alone + F.row_number().over(along.orderBy("k", "t")))


def rare_pairs(members: DataFrame, labels: DataFrame, hot: list[int]) -> DataFrame:
    """Pairs (h, x) of a stray and a member of another component that share a rare enough shingle."""
    known = with_components(members, labels, hot).withColumn("stray", F.col("component") != F.col("main"))
    least = known.groupBy("h").agg(F.min("f").alias("least_f"), F.min(F.when(F.col("stray"), F.col("f"))).alias("least_stray_f"))
    known = beside(known, least, "h", hot)
    whole = 100 + THRESHOLD

    def usable(partner_f: str):
        """How many of its shingles a member must try to meet partners of at least this f."""
        k = F.ceil((F.col("f") + F.col(partner_f) - whole * F.col("c")) / whole - F.lit(1e-9))
        return F.size("apart") - F.greatest(F.lit(1), k) + 1

    # strays ask, with a view to any partner; members answer, with a view to strays
    known = known.withColumns({"asks": F.when(F.col("stray"), usable("least_f")).otherwise(0), "answers": usable("least_stray_f")})
    known = cut(known.where("asks > 0 or answers > 0"))
    tokens = known.select("h", "x", "m", "v", "c", "f", "component", "asks", "answers", F.size("apart").alias("size"), F.explode("apart").alias("s"))
    tokens = tokens.withColumn("t", F.xxhash64("h", "s"))
    first = cut(rarest_first(tokens, ["h", "x"]).where("nth <= greatest(asks, answers)"))
    x, y = first.where("nth <= asks").alias("x"), first.where("nth <= answers").alias("y")
    room = whole * (F.least("x.m", "y.m") + F.least("x.v", "y.v") + F.col("x.c")) >= F.col("x.f") + F.col("y.f")
    meet = (F.col("x.t") == F.col("y.t")) & (F.col("x.h") == F.col("y.h")) & (F.col("x.component") != F.col("y.component")) & room
    return x.join(y, meet).select(F.least("x.x", "y.x").alias("h"), F.greatest("x.x", "y.x").alias("x"))


def exploded(texts: DataFrame) -> DataFrame:
    """x, one (which of its texts), size and shingle t of every (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            for i, sets in sets_of(batch.column("text"), words):
                one = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
                offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                ts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, U), *sets]).view(np.int64)))
                yield pa.record_batch([batch.column("id").slice(i, len(sets)), pa.array(one, pa.int64()), pa.array(np.diff(offsets), pa.int64()), ts], ["x", "one", "size", "ts"])

    return texts.select("id", "text").mapInArrow(run, "x long, one long, size long, ts array<long>").select("x", "one", "size", F.explode("ts").alias("t"))


def far_pairs(overlaps: DataFrame, labels: DataFrame, texts: DataFrame, hot: list[int]) -> DataFrame:
    """Pairs (h, x) of members unlike a hub and members not much like it that share a rare enough shingle of their full sets."""
    narrow = overlaps.where(100 * F.col("a") < 65 * (F.col("n_h") + F.col("n") - F.col("a"))).select("h", "x", F.col("novel").isNull().alias("far"))
    several_parts = with_components(overlaps.select("h", "x"), labels, hot).select("h").distinct()
    known = beside(narrow, several_parts, "h", hot).groupBy("x").agg(F.max("far").alias("far"))
    known = cut(known.join(labels.select(F.col("id").alias("x"), "component"), "x", "left").withColumn("component", F.coalesce("component", "x")))
    chosen = texts.join(known.select(F.col("x").alias("id")), "id", "left_semi").dropDuplicates(["id", "text"])
    first = rarest_first(exploded(chosen), ["x", "one"]).where(f"nth <= size - (size * {THRESHOLD} + 99) div 100 + 1")
    first = cut(first.select("x", "size", "t", "nth").join(known, "x"))
    x, y = first.alias("x"), first.alias("y")
    n, m = F.col("x.size"), F.col("y.size")
    meet = (F.col("x.t") == F.col("y.t")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.far") | F.col("y.far"))
    meet &= ((n < m) | ((n == m) & (F.col("x.x") < F.col("y.x")))) & (100 * n >= THRESHOLD * m)
    meet &= F.expr(f"x.nth <= x.size - (x.size * {2 * THRESHOLD} + {99 + THRESHOLD}) div {100 + THRESHOLD} + 1")
    meet &= linked(F.least(n - F.col("x.nth"), m - F.col("y.nth")) + 1, n, m)
    return x.join(y, meet).select(F.least("x.x", "y.x").alias("h"), F.greatest("x.x", "y.x").alias("x"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    sketch = cut(sketched(docs))
    classes = cut(
        sketch.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
        .groupBy("digest").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.min("bands").alias("bands"))
    )
    in_buckets = classes.select(F.explode("bands").alias("bucket"), F.col("id").alias("x"))
    counts = cut(in_buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    hot = hot_keys(counts, "bucket", "c")
    crowded = cut(beside(in_buckets, counts, "bucket", hot))

    # 2. the hub of a bucket
    weight = crowded.groupBy("x").agg(F.sum("c").alias("met"))
    weighed = crowded.drop("c").join(weight, "x")
    hubs = weighed.groupBy("bucket").agg(F.max(F.struct("met", F.xxhash64("x"), "x")).alias("top")).select("bucket", F.col("top.x").alias("h"))
    rows = cut(beside(crowded.select("bucket", "x"), hubs, "bucket", hot).where("x <> h").select("h", "x").distinct())
    by_id = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    involved = crowded.select(F.col("x").alias("id")).distinct()
    texts = cut(by_id.join(involved.hint("shuffle_hash"), "id", "left_semi"))
    overlaps = cut(compared(rows, texts))
    hot = hot_keys(overlaps.groupBy("h").agg(F.count(F.lit(1)).alias("c")), "h", "c")
    found = overlaps.where(linked(F.col("a"), F.col("n_h"), F.col("n"))).select(F.col("h").alias("a"), F.col("x").alias("b"))
    labels = components(found)

    # 3. links that the distances from a group's consensus prove
    none = F.expr("cast(array() as array<long>)")
    itself = overlaps.groupBy("h").agg(F.max("n_h").alias("n"))
    itself = itself.select("h", F.col("h").alias("x"), "n", F.col("n").alias("n_h"), none.alias("novel"), none.alias("missing"))
    close = overlaps.where(F.col("novel").isNotNull()).select(*itself.columns).unionAll(itself)
    close = with_components(close, labels, hot).select(*itself.columns)
    members = cut(against_consensus(cut(close), hot))
    labels = merged(labels, central_links(members, hot))

    # 4. what may still link two components
    pairs = rare_pairs(members, labels, hot).unionAll(far_pairs(overlaps, labels, texts, hot)).distinct()
    late = compared(pairs, texts).where(linked(F.col("a"), F.col("n_h"), F.col("n"))).select(F.col("h").alias("a"), F.col("x").alias("b"))
    labels = merged(labels, late)

    of_class = classes.select("digest", "id").join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    known = sketch.where(F.col("digest").isNotNull()).select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    empty = sketch.where(F.col("digest").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    rows = known.select(*empty.columns).unionAll(empty)
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def survivors(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest of their component, with the columns of ``docs``.

    Where doc_ids repeat, each (doc_id, text) is a document of its own; of a
    component the smallest doc_id stays, and of its texts the one of the
    smallest digest.
    """
    if docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        dropped = near_dedup(docs).where(~F.col("kept")).select("doc_id").distinct()
        return docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("_in_digest")
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", digest).distinct()
    nodes = cut(texts.withColumn("_node", F.monotonically_increasing_id()))
    marked = docs.select("*", digest)
    keys = ["doc_id", "_in_digest"]
    named = cut(marked.select(*keys, "text").dropDuplicates(keys).join(nodes, keys).select(F.col("_node").alias("doc_id"), "text"))
    found = near_dedup(named).select(F.col("doc_id").alias("_node"), "component_id")
    found = cut(found.join(nodes, "_node"))
    best = found.groupBy("component_id").agg(F.min(F.struct(*keys)).alias("best"))
    dropped = found.join(best, "component_id").where(F.struct(*keys) != F.col("best")).select(*keys)
    return marked.join(dropped.hint("shuffle_hash"), keys, "left_anti").select(*docs.columns)
