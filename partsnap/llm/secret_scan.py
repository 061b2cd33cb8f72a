"""Secret scan: fixed patterns, and strings that a tokenizer spends many tokens on.

Base kinds are ``assign`` (a password, token or key given a value), ``access``
(cloud access key ids) and ``hex`` (long lower-case hexadecimal runs).  The
method adds ``random``: strings whose characters per token, under a public
byte-pair vocabulary, are below ``MAX_CHARS_PER_TOKEN``.  Words of any language
that the vocabulary knows take few tokens; keys take many, whatever kinds of
characters they mix.  Known digests and identifiers are not random: hexadecimal
strings of a digest's length, UUIDs, and plain numbers (no letter); neither is
what a base span already covers.

Tested are maximal runs of ``[A-Za-z0-9+/_=-]``, less the base spans, digests
and UUIDs in them.  Words dilute a key in the same run, so where the rest of a
run is not random as a whole, it is tested from its first to its last part
(between signs) that is not a known word, then by stretches of such parts, then
part by part.

Whole texts are read; positions are code points, end exclusive.

Defined cases: null and empty texts have no span (``base_sha256`` is that of an
empty string); null doc_id is returned as it is; repeated rows each give
their row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "random")
MIN_CHARS = 20
MAX_CHARS_PER_TOKEN = 2.3
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
HINTS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})(?![A-Za-z0-9])")
TAIL = re.compile(r"[A-Za-z0-9+/_=-]*")
PART = re.compile(r"[A-Za-z0-9]+")
SIGNS = "/_=-"
LETTER = re.compile(r"[A-Za-z]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the fixed patterns, sorted."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def identifier(s: str) -> bool:
    """Known digests, UUIDs, and plain numbers."""
    return bool(DIGEST.match(s) or UUID.match(s)) or not LETTER.search(s)


def rests(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What base spans (sorted by start), digests and UUIDs leave of the runs, without the signs next to them."""
    # an assigned value reaches to the end of its run
    spans = [(a, TAIL.match(text, b).end() if k == 0 else b) for a, k, b in base]
    first = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while first < len(spans) and spans[first][1] <= start:
            first += 1
        i, taken = first, [k.span() for k in KNOWN.finditer(text, start, end)]
        while i < len(spans) and spans[i][0] < end:
            taken.append(spans[i])
            i += 1
        at = start
        for a, b in [*sorted(taken), (end, end)]:
            lo, hi = at, min(a, end)
            while lo > start and lo < hi and text[lo] in SIGNS:
                lo += 1
            while hi < end and lo < hi and text[hi - 1] in SIGNS:
                hi -= 1
            if hi - lo >= MIN_CHARS:
                yield lo, hi
            at = max(at, b)


def random_spans(text: str, count: Callable[[str], int], base: list[tuple[int, int, int]], limit: float) -> list[tuple[int, int, int]]:
    """Strings outside of base spans (sorted by start) that take many tokens."""

    def many(a: int, b: int) -> bool:
        return b - a < limit * count(text[a:b])

    def random(a: int, b: int) -> bool:
        return b - a >= MIN_CHARS and not identifier(text[a:b]) and many(a, b)

    out = []
    for start, end in rests(text, base):
        if random(start, end):
            out.append((start, 3, end))
            continue
        parts = [p.span() for p in PART.finditer(text, start, end)]
        stretches = [list(g) for rare, g in groupby(parts, lambda p: many(*p)) if rare]
        if not stretches:
            continue
        if random(a := stretches[0][0][0], b := stretches[-1][-1][1]):
            out.append((a, 3, b))
            continue
        for g in stretches:
            if random(g[0][0], g[-1][1]):
                out.append((g[0][0], 3, g[-1][1]))
            else:
                out += [(a, 3, b) for a, b in g if random(a, b)]
    return out


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def load_vocabulary(path: str, pattern: str):
    """The tiktoken encoding of a file of ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def scan(docs: DataFrame, vocabulary: str | None = None, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """Counts, digest and list of spans of every row.

    ``vocabulary`` is a path of tiktoken ranks that every executor can read;
    by default that of the installed ``public_tokenizers``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoding = load_vocabulary(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

        def count(s: str) -> int:
            return len(encoding.encode_ordinary(s))

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base = base_spans(text or "")
                extra = random_spans(text or "", count, base, max_chars_per_token)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc_id, *n, len(extra), hashlib.sha256(told(base).encode()).hexdigest(), told(sorted(base + extra))))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
