"""Periodic runs of words, found by recursive frequency splitting.

A run is a maximal stretch of consecutive words with smallest period q (words q
apart are equal) and a length of at least ``MIN_LENGTH`` and ``MIN_PERIODS * q``.
Every word of a run occurs in it ``MIN_PERIODS`` times or more, so a word that
occurs less often within its segment lies in no run there: it splits the segment.
The parts are counted again, until no word is too rare (or, after ``MAX_ROUNDS``
rounds, as they are: splitting only saves work).  Surviving segments are scanned
lag by lag.  A run of lag q covers ``MIN_PERIODS`` multiples of q, so the scan
looks at multiples only, where one comparison of two hashes tells whether the next
words repeat at that lag: n log n looks for n words.  What the hashes say is
compared word by word at the end; a text in which they failed is scanned again by
exact word numbers.

Defined cases: null and empty texts have no words and no run (nulls for the
longest run, digests of empty strings); a null doc_id is returned as it is;
repeated rows each give their row; an empty table gives an empty result; other
columns are not read.  Texts are independent: no shuffle, whole texts, any length
that fits a task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD
from .textops import U, Words, mix, slices

MIN_LENGTH = 6
MIN_PERIODS = 4
MAX_ROUNDS = 64
SLICE_BYTES = 8 << 20
BASE = U(0x9E3779B97F4A7C15)

SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
Run = tuple[int, int, int]


def split(words: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments that may hold a run; ``texts`` has the first word of each text, and their end."""
    starts, ends = texts[:-1].astype(np.int64), texts[1:].astype(np.int64)
    done = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for _ in range(MAX_ROUNDS):
        long = ends - starts >= MIN_LENGTH
        starts, ends = starts[long], ends[long]
        if not len(starts):
            break
        size = ends - starts
        segment = np.repeat(np.arange(len(starts)), size)
        first = np.cumsum(size) - size
        at = np.arange(len(segment)) + np.repeat(starts - first, size)
        # equal words of a segment have equal keys; a clash of others can only spare a word
        keys = words[at] ^ (segment.astype(U) * BASE)
        order = np.argsort(keys)
        group = np.cumsum(np.append(False, keys[order[1:]] != keys[order[:-1]]))
        rare = np.zeros(len(at), bool)
        rare[order] = np.bincount(group)[group] < MIN_PERIODS
        split_up = np.logical_or.reduceat(rare, first)
        done.append((starts[~split_up], ends[~split_up]))
        # the others go on as their maximal stretches of frequent words
        live = ~rare & split_up[segment]
        joined = live[1:] & live[:-1] & (segment[1:] == segment[:-1])
        begins, stops = live.copy(), live.copy()
        begins[1:] &= ~joined
        stops[:-1] &= ~joined
        starts, ends = at[begins], at[stops] + 1
    else:
        done.append((starts, ends))
    starts, ends = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(starts)
    return starts[order], ends[order]


def extent(w: np.ndarray, q: int, a: int, b: int) -> tuple[int, int]:
    """The maximal stretch in which words q apart are equal, around that of words a to b."""
    step = 64
    while a > 0:
        k = min(a, step)
        other = np.flatnonzero(w[a - k : a] != w[a - k + q : a + q])
        if len(other):
            a += int(other[-1]) + 1 - k
            break
        a, step = a - k, 2 * step
    step = 64
    while b < len(w):
        k = min(len(w) - b, step)
        other = np.flatnonzero(w[b : b + k] != w[b - q : b - q + k])
        if len(other):
            b += int(other[0])
            break
        b, step = b + k, 2 * step
    return a, b


def stretches(w: np.ndarray, q: int) -> list[tuple[int, int]]:
    """All maximal stretches in which words q apart are equal over more than one period."""
    edge = np.diff(np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]]))
    return [(a, b + q) for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), strict=True) if b - a > q]


def scan(w: np.ndarray) -> list[Run]:
    """(start, length, period) of all runs of a segment of word numbers."""
    n = len(w)
    power = np.cumprod(np.append(U(1), np.full(n, BASE, U)))
    prefix = np.append(U(0), np.cumsum(w * power[:n]))
    runs: dict[int, tuple[list[int], list[int]]] = {}  # by period: starts and ends, ascending

    def known(a: int, b: int, q: int) -> bool:
        """Words a to b lie in a run whose period divides q."""
        for p, (starts, ends) in runs.items():
            if q % p == 0:
                i = bisect_right(starts, a) - 1
                if i >= 0 and ends[i] >= b:
                    return True
        return False

    for q in range(1, n // MIN_PERIODS + 1):
        sample = w[::q]
        if not (sample[1:] == sample[:-1]).any():
            continue
        # of the multiples of q in a run of q, the first repeats, with all words up to the third, q words later
        span = (MIN_PERIODS - 2) * q
        at = np.arange(0, n - span - q + 1, q)
        same = (prefix[at + span] - prefix[at]) * power[q] == prefix[at + span + q] - prefix[at + q]
        at = at[same]
        if not len(at):
            continue
        cuts = np.flatnonzero(np.diff(at) > q)
        groups = zip(at[np.append(0, cuts + 1)].tolist(), (at[np.append(cuts, len(at) - 1)] + span + q).tolist(), strict=True)
        groups = [(a, b) for a, b in groups if not known(a, b, q)]
        if all(np.array_equal(w[a : b - q], w[a + q : b]) for a, b in groups):
            groups = [extent(w, q, a, b) for a, b in groups]
        else:  # sums that are equal by chance
            groups = [(a, b) for a, b in stretches(w, q) if not known(a, b, q)]
        groups = [(a, b) for a, b in groups if b - a >= max(MIN_LENGTH, MIN_PERIODS * q)]
        if groups:
            runs[q] = ([a for a, _ in groups], [b for _, b in groups])
    return [(a, b - a, q) for q, (starts, ends) in runs.items() for a, b in zip(starts, ends, strict=True)]


def runs_of(hashes: np.ndarray, segments: list[tuple[int, int]], words: list[bytes]) -> list[Run]:
    """Runs of a text (by start, then period) from its word hashes and segments, checked on the words."""
    found = sorted((a + s, m, q) for a, b in segments for s, m, q in scan(hashes[a:b]))
    if all(words[s + q : s + m] == words[s : s + m - q] for s, m, q in found):
        return sorted(found, key=lambda r: (r[0], r[2]))
    ids: dict[bytes, int] = {}
    exact = mix(np.array([ids.setdefault(x, len(ids)) for x in words], U))
    return sorted(scan(exact), key=lambda r: (r[0], r[2]))


def told(words: list[bytes], runs: list[Run]) -> tuple:
    """The result columns of a text."""
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    if runs:
        kept = np.ones(len(words), bool)
        for s, m, q in runs:
            kept[s + q : s + m] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = 1000 * length // period if runs else None
    return len(runs), start, length, period, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


def find_runs(docs: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the words without repeats, of every row."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Words()
        for batch in batches:
            rows = []
            for _, _, data, offsets in slices(batch.column("text"), SLICE_BYTES):
                begins, stops, first = hasher.bounds(data, offsets)
                hashes = hasher.hashes(data, begins, stops)
                starts, ends = split(hashes, first)
                owner = np.searchsorted(first, starts, side="right") - 1
                segments: dict[int, list[tuple[int, int]]] = {}
                for t, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    segments.setdefault(t, []).append((a - int(first[t]), b - int(first[t])))
                for t in range(len(offsets) - 1):
                    words = data[offsets[t] : offsets[t + 1]].tobytes().split()
                    rows.append(told(words, runs_of(hashes[first[t] : first[t + 1]], segments[t], words) if t in segments else []))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a repeat planted in a tenth of the rows (by the CRC-32 of doc_id).

    With h that CRC, g = h div 10 and n words, every word i from a = g % n on becomes word a + (i - a) % p,
    where p = 1 + (n - a) div (3 + g % 8).  A null doc_id gets none.
    """
    words = docs.selectExpr("cast(doc_id as long) doc_id", "text", "crc32(cast(cast(doc_id as long) as string)) h")
    words = words.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))))
    words = words.withColumns({"n": F.size("w"), "g": F.expr("h div 10")}).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    words = words.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')")
    return words.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))
