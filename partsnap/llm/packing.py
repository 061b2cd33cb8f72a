"""Best-fit packing of token sequences by exact-complement hashing.

Tokenising tasks cut documents into pieces of at most ``capacity`` tokens and
number the pieces of each length as they go.  Only the histogram of lengths
(at most ``capacity`` counts, whatever the size of the corpus) reaches the
driver, which plans in counts, not in pieces:

1. For each length a, longest first, the gap ``capacity - a`` is filled
   exactly by one length, else by a pair, else by a triple whose sum is the
   gap.  The index of single, pair and triple sums is looked up under the
   counts still available, and a combination is consumed as often as its
   scarcest length allows.
2. What is left is packed best-fit, longest first: pieces of one length go to
   the open sequences with the smallest gap that holds them, as many at once
   as both allow.

A plan line says: pieces of length L with numbers [first, first + times) go to
sequences base, base + 1, ... at one offset.  Pieces get a gapless number per
length from counts by (length, task), and look their line up.

A document longer than the capacity is cut into full pieces; the first one
takes the remainder.  Token id 0 ends each document.  Ids are those of the
tokenizers library by default, added tokens included.  Texts go through
tiktoken, which makes the same merges in a quarter of the time; texts that hold
an added token (tiktoken would split it as plain text) or ``LONG_WHITE``
characters of white space in a row (tiktoken's pattern fails on a million) go
through the tokenizers library itself.

Defined cases: null and empty texts are the single token 0; rows that repeat a
doc_id each give their pieces; null doc_id is carried along; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

CAPACITY = 2048
LONG_WHITE = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, run int, nth long"


# ---------------------------------------------------------------- tokens

def byte_of_char() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoding(path: str, pattern: str):
    """A tiktoken encoding with the vocabulary of a byte-level tokenizers file."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    special = {t["content"] for t in said.get("added_tokens", ())}
    back = byte_of_char()
    ranks = {bytes(back[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def load_ids(path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """The function from a text to the ids that the tokenizers library gives it by default."""
    from tokenizers import Tokenizer

    encoding = load_encoding(path, pattern)
    with open(path, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f).get("added_tokens", ())]
    white = re.compile(r"\s+")
    library = None  # loaded for the first text that needs it

    def ids(text: str) -> np.ndarray:
        nonlocal library
        long_white = len(text) >= LONG_WHITE and any(m.end() - m.start() >= LONG_WHITE for m in white.finditer(text))
        if not long_white and not any(t in text for t in added):
            return encoding.encode_to_numpy(text, disallowed_special=())
        library = library or Tokenizer.from_file(path)
        return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def cut_lengths(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def tokenised(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row per piece, with the task (run) and the piece's number among the task's pieces of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        from pyspark import TaskContext

        encode = load_ids(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        names = [x.split()[0] for x in PIECES.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), 0).astype("<u4")
                for i, (start, length) in enumerate(cut_lengths(len(ids), capacity)):
                    rows.append((doc_id, i, start, length, zlib.crc32(ids[start : start + length].tobytes()), task, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, PIECES)


# ---------------------------------------------------------------- plan

def exact_fill(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths whose sum is ``gap``, longest first; None if there are none.

    ``have`` are the available counts by length; lengths used twice or three
    times must have that count.
    """
    if gap <= 0 or gap >= len(have):
        return None
    if have[gap]:
        return (gap,)
    longest = np.arange(gap - 1, 0, -1)
    longest = longest[have[longest] > 0]
    if not len(longest):
        return None
    pair = longest[2 * longest >= gap]
    other = gap - pair
    ok = have[other] >= np.where(other == pair, 2, 1)
    if ok.any():
        a = int(pair[ok][0])
        return (a, gap - a)
    for a in longest:
        a = int(a)
        if 3 * a < gap:
            break
        left = gap - a
        have[a] -= 1
        b = longest[(longest <= min(a, left - 1)) & (2 * longest >= left)]
        c = left - b
        ok = (have[b] > 0) & (have[c] >= np.where(b == c, 2, 1))
        have[a] += 1
        if ok.any():
            b0 = int(b[ok][0])
            return (a, b0, left - b0)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first, times, sequence base, offset) lines that place every counted piece."""
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    used = np.zeros(capacity + 1, np.int64)
    lines: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def take(length: int, times: int, base: int, offset: int) -> None:
        lines.append((length, int(used[length]), times, base, offset))
        used[length] += times
        have[length] -= times

    for a in range(capacity, 0, -1):
        while have[a]:
            if a == capacity:
                parts: tuple[int, ...] = (a,)
            else:
                have[a] -= 1
                rest = exact_fill(have, capacity - a)
                have[a] += 1
                if rest is None:
                    break
                parts = (a, *rest)
            need: dict[int, int] = defaultdict(int)
            for x in parts:
                need[x] += 1
            times = min(int(have[x]) // n for x, n in need.items())
            offset = 0
            for x in parts:
                take(x, times, sequences, offset)
                offset += x
            sequences += times
    # best fit of the rest: groups of sequences with equal gap, (first sequence, how many)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    open_gap = np.zeros(capacity + 1, bool)
    for a in range(capacity, 0, -1):
        while have[a]:
            fits = np.flatnonzero(open_gap[a:])
            if len(fits):
                gap = a + int(fits[0])
                base, n = gaps[gap].pop()
                times = min(n, int(have[a]))
                if n > times:
                    gaps[gap].append((base + times, n - times))
                open_gap[gap] = bool(gaps[gap])
            else:
                gap, base = capacity, sequences
                times = -(-int(have[a]) // (capacity // a))
                sequences += times
            take(a, times, base, capacity - gap)
            if gap > a:
                gaps[gap - a].append((base, times))
                open_gap[gap - a] = True
    return lines


# ---------------------------------------------------------------- placing

def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    pieces = cut(tokenised(docs, capacity, vocabulary))
    by_run = pieces.groupBy("length", "run").agg(F.count(F.lit(1)).alias("n"))
    along = W.partitionBy("length").orderBy("run").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = cut(by_run.withColumn("before", F.sum("n").over(along) - F.col("n")))
    histogram = {r["length"]: r["n"] for r in first.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    lines = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(lines)  # bounded by the capacity, not by the corpus

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        length_at = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            at = np.zeros(len(length), np.int64)
            for x in np.unique(length):
                rows = length == x
                lo, hi = length_at[x], length_at[x + 1]
                at[rows] = lo + np.searchsorted(table[lo:hi, 1], number[rows], side="right") - 1
            line = table[at] if len(at) else np.zeros((0, 5), np.int64)
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(line[:, 3] + number - line[:, 1], pa.int64()), pa.array(line[:, 4], pa.int64())]
            yield pa.record_batch(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = pieces.join(first.drop("n"), ["length", "run"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number")
    )
    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
