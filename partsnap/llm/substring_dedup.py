"""Repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document; its minimiser is the
smallest hash among its runs of ``RUN`` words.  Consecutive windows with one
minimiser travel together, as one packed string of words (a super-k-mer), to
the bucket of that minimiser.  Equal windows have equal minimisers, so each
bucket can tell by sorting its windows which of them start earlier elsewhere,
exactly: windows are sorted by a hash of their words, and windows of equal
hash are compared byte by byte.

Skew has two remedies.  Tasks combine before they send: of super-k-mers with
equal words in one chunk only the earliest travels, and the others' words are
known to be repeats.  And minimisers that many different super-k-mers share
(common lines or phrases) are found by a first pass that counts super-k-mers
in ``CELLS`` cells of the hash range; windows with such a minimiser travel one
by one, to the bucket of the hash of the whole window.

Covered word ranges come back by doc_id and are joined to the texts.

Defined cases: null, empty and word-less texts have no words (the digest is
that of an empty string); documents shorter than a window keep all words; a
null doc_id takes no part and keeps all words; rows that repeat a doc_id count
as one document (equal places are not earlier than each other), and ranges
found in one are removed from each; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .textops import U, Words, mix, numbers, slices

WINDOW = 20
RUN = 3
CELLS = 1 << 16
HOT = 16  # times the mean of a cell
CHUNK = 4 << 20
LONGEST = 256  # windows of one packed string
BUCKETS_PER_TASK = 4
LEVEL = 3  # of zstd


def window_minimisers(h: np.ndarray, first: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, owner, minimiser) of all windows of texts with word hashes ``h``."""
    n = np.diff(first)
    count = np.maximum(n - window + 1, 0)
    if not count.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    weights = numbers(41, run) | U(1)
    m = len(h) - run + 1
    x = np.zeros(m, U)
    for j in range(run):
        x += h[j : m + j] * weights[j]
    x = mix(x)
    width, done = window - run + 1, 1
    while done < width:  # minimum over `width` runs by doubling
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    owner = np.repeat(np.arange(len(n)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[owner]
    return at, owner, x[at]


def super_kmers(at: np.ndarray, owner: np.ndarray, key: np.ndarray, alone: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(first window's index, number of windows) of runs of consecutive windows with one key."""
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    new |= alone
    begin = np.flatnonzero(new)
    nth = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(new | (nth % longest == 0))
    return begin, np.diff(np.append(begin, len(at)))


def squeezed(numbers_: np.ndarray, squeeze) -> bytes:
    """Ascending-ish integers as compressed differences, byte planes apart."""
    steps = np.diff(numbers_.astype(np.int64), prepend=0)
    return squeeze.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def expanded(blob: bytes, expand) -> np.ndarray:
    planes = np.frombuffer(expand.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


class Splitter:
    """Cuts a run of texts into super-k-mers."""

    def __init__(self, window: int, run: int, hot: np.ndarray):
        self.words, self.window, self.run, self.hot = Words(), window, run, hot
        self.weights = numbers(43, window) | U(1)

    def split(self, buf: np.ndarray, offsets: np.ndarray):
        starts, ends, first = self.words.bounds(buf, offsets)
        h = self.words.hashes(buf, starts, ends)
        at, owner, key = window_minimisers(h, first, self.window, self.run)
        alone = np.zeros(len(at), bool)
        if len(self.hot) and len(at):
            alone = np.isin(key >> U(48), self.hot)
            whole = np.zeros(int(alone.sum()), U)
            for j in range(self.window):
                whole += h[at[alone] + j] * self.weights[j]
            key[alone] = mix(whole)
        begin, count = super_kmers(at, owner, key, alone, LONGEST)
        return starts, ends, first, at[begin], owner[begin], key[begin], count


def packed_strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, n_words: np.ndarray) -> list[bytes]:
    """The words of each super-k-mer joined by one space, whatever stood between them."""
    size = ends - starts
    before = np.cumsum(size) - size
    to = before + np.arange(len(size))  # one space follows each word
    plain = np.full(int(size.sum()) + len(size), 32, np.uint8)
    nth = np.arange(int(size.sum()))
    plain[nth + np.repeat(to - before, size)] = buf[nth + np.repeat(starts - before, size)]
    raw = plain.tobytes()
    last = at + n_words - 1
    return [raw[a:b] for a, b in zip(to[at].tolist(), (to[last] + size[last]).tolist(), strict=True)]


def hot_cells(docs: DataFrame, window: int, run: int) -> np.ndarray:
    """Cells (top 16 bits of the minimiser) with over ``HOT`` times the mean of super-k-mers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(window, run, np.zeros(0, U))
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, _, buf, offsets in slices(batch.column("text"), CHUNK):
                starts, ends, _, at, _, key, n = splitter.split(buf, offsets)
                h = splitter.words.hashes(buf, starts, ends)
                # super-k-mers with equal words count once a chunk, as they will travel once
                same = np.cumsum(h, dtype=U)
                last = at + n + window - 2
                whole = mix((same[last] - same[at] + h[at]) ^ (key * U(3)))
                _, one = np.unique(whole, return_index=True)
                total += np.bincount((key[one] >> U(48)).astype(np.int64), minlength=CELLS)
        cell = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cell, pa.int32()), pa.array(total[cell], pa.int64())], ["cell", "n"])

    counts = cut(docs.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    mean = (counts.agg(F.sum("n")).first()[0] or 0) / CELLS
    hot = [r["cell"] for r in counts.where(F.col("n") > max(HOT * mean, 64)).select("cell").collect()]
    return np.array(sorted(hot), U)


def sent(docs: DataFrame, window: int, run: int, hot: np.ndarray, n_buckets: int) -> DataFrame:
    """Compressed packed strings with their places by bucket; rows of bucket -1 are ranges already known to repeat."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        splitter = Splitter(window, run, hot)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, buf, offsets in slices(batch.column("text"), CHUNK):
                starts, ends, first, at, owner, key, count = splitter.split(buf, offsets)
                if not len(at):
                    continue
                strings = packed_strings(buf, starts, ends, at, count + window - 1)
                doc, place = ids[i:j][owner], at - first[owner]
                order = np.lexsort((place, doc))
                seen: dict[bytes, int] = {}
                repeats = np.zeros(len(at), bool)
                for x in order.tolist():
                    y = seen.setdefault(strings[x], x)
                    # the same place of a repeated row is not a repeat
                    repeats[x] = y != x and (doc[y] != doc[x] or place[y] != place[x])
                    if y != x and not repeats[x]:
                        repeats[x] = repeats[y]
                kept = np.fromiter(seen.values(), np.int64, len(seen))
                bucket = (key[kept] % U(n_buckets)).astype(np.int64)
                kept = kept[np.argsort(bucket, kind="stable")]
                bucket.sort()
                edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                groups = [kept[a:b] for a, b in zip(edges, np.append(edges[1:], len(kept)), strict=True)]
                rows = [
                    (int(bucket[a]), squeeze.compress(b"\n".join([strings[x] for x in g.tolist()])), squeezed(doc[g], squeeze), squeezed(place[g], squeeze))
                    for a, g in zip(edges.tolist(), groups, strict=True)
                ]
                gone = np.flatnonzero(repeats)
                if len(gone):
                    to = place[gone] + count[gone] + window - 1
                    rows.append((-1, squeezed(to, squeeze), squeezed(doc[gone], squeeze), squeezed(place[gone], squeeze)))
                columns = zip(*rows, strict=True)
                types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "words", "docs", "places"])

    rows = docs.where(F.col("doc_id").isNotNull()).selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(send, "bucket int, words binary, docs binary, places binary")


def later_windows(h: np.ndarray, doc: np.ndarray, place: np.ndarray, same: Callable[[int, int], bool]) -> np.ndarray:
    """Which windows have an equal one that starts earlier.

    ``h`` are hashes of the windows; ``same`` tells whether two windows of one
    hash agree in every word.
    """
    late = np.zeros(len(h), bool)
    order = np.argsort(h)
    twin = h[order][1:] == h[order][:-1]
    several = order[np.append(twin, False) | np.append(False, twin)]
    several = several[np.lexsort((place[several], doc[several], h[several]))]
    head: list[int] = []  # the earliest window of each text with the present hash
    last = None
    for x, value in zip(several.tolist(), h[several].tolist(), strict=True):
        if value != last:
            head, last = [x], value
            continue
        for y in head:
            if same(x, y):
                late[x] = doc[x] != doc[y] or place[x] != place[y]
                break
        else:
            head.append(x)
    return late


def covered(key: tuple[pa.Scalar, ...], table: pa.Table, window: int = WINDOW) -> pa.Table:
    """(doc_id, begin, end) word ranges of the repeated windows of one bucket."""
    import zstandard

    names = ["doc_id", "begin", "end"]
    expand = zstandard.ZstdDecompressor()
    doc, place = (np.concatenate([expanded(b.as_py(), expand) for b in table.column(c)]) for c in ("docs", "places"))
    if key[0].as_py() == -1:
        end = np.concatenate([expanded(b.as_py(), expand) for b in table.column("words")])
        return pa.table([pa.array(doc), pa.array(place, pa.int32()), pa.array(end, pa.int32())], names)
    raw = b"\n".join([expand.decompress(b.as_py()) for b in table.column("words")])
    buf = np.frombuffer(raw, np.uint8)
    lines = np.concatenate([[0], np.flatnonzero(buf == 10) + 1, [len(buf)]])
    words = Words()
    starts, ends, first = words.bounds(buf, lines)
    h = words.hashes(buf, starts, ends)
    words.grow(len(h) + 1)
    total = np.append(U(0), np.cumsum(h * words.up[: len(h)], dtype=U))
    count = np.diff(first) - window + 1
    owner = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = nth + first[owner]
    begin = place[owner] + nth
    whole = mix((total[at + window] - total[at]) * words.down[at])
    from_, to = starts[at], ends[at + window - 1]

    def same(x: int, y: int) -> bool:
        return raw[from_[x] : to[x]] == raw[from_[y] : to[y]]

    late = later_windows(whole, doc[owner], begin, same)
    at, owner, begin = at[late], owner[late], begin[late]
    # neighbours within one super-k-mer become one range
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    edge = np.flatnonzero(new)
    length = np.diff(np.append(edge, len(at)))
    return pa.table([pa.array(doc[owner[edge]]), pa.array(begin[edge], pa.int32()), pa.array(begin[edge] + length - 1 + window, pa.int32())], names)


def repeated_ranges(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc_id, begin, end): word ranges (from 0, end exclusive) covered by windows that also start earlier."""
    spark = docs.sparkSession
    n_tasks = max(docs.rdd.getNumPartitions() * 3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_cells(docs.where(F.col("doc_id").isNotNull()), window, run)
    rows = sent(docs, window, run, hot, n_tasks * BUCKETS_PER_TASK)
    # known ranges need no meeting: spread them as they come
    rows = rows.withColumn("salt", F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("docs"), F.lit(n_tasks))).otherwise(F.lit(0)))

    def solve(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return covered(key, table, window)

    return rows.repartition(n_tasks, "bucket", "salt").groupBy("bucket", "salt").applyInArrow(solve, "doc_id long, begin int, end int")


def remove_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row (and the words that are left, with ``keep_text``)."""
    ranges = repeated_ranges(docs, window, run)
    by_doc = cut(ranges.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("gone")))
    base = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    known = base.where(F.col("doc_id").isNotNull()).join(by_doc.hint("shuffle_hash"), "doc_id", "left")
    unknown = base.where(F.col("doc_id").isNull()).select("doc_id", "text", F.lit(None).cast(by_doc.schema["gone"].dataType).alias("gone"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest, texts = [], [], [], []
            for text, gone in zip(batch.column("text").cast(pa.large_binary()), batch.column("gone").to_pylist(), strict=True):
                words = (text.as_py() or b"").split()  # bytes split at the six white-space characters only
                left, done = [], 0
                for r in gone or ():
                    if r["begin"] > done:
                        left += words[done : r["begin"]]
                    done = max(done, r["end"])
                left += words[done:]
                whole = b" ".join(left)
                total.append(len(words))
                removed.append(len(words) - len(left))
                digest.append(hashlib.sha256(whole).hexdigest())
                texts.append(whole)
            columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            if keep_text:
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
            yield pa.record_batch(columns, names)

    return known.unionAll(unknown).mapInArrow(finish, schema)
