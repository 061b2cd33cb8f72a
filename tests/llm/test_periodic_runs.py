"""Periodic runs against a scan of every lag."""

import hashlib
import random
import re
import zlib

import numpy as np

from partsnap.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    n, seen, out = len(w), set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and (i, j) not in {(s, e) for s, e in seen}:
                stretch = (i, j + q)
                if stretch not in seen:
                    seen.add(stretch)
                    out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=False):
    w = WORD.findall(text or "")
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if h % 10 == 0:
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *digest)


def texts():
    rng = random.Random(11)
    for _ in range(250):
        words, kinds = [], rng.choice([1, 2, 3, 6, 30])
        while len(words) < rng.randrange(150):
            words += [f"é{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 9))] * rng.choice([1, 1, 2, 3, 4, 5, 9])
        yield rng.choice([" ", "\n", " \t"]).join(words)


def test_equals_brute_force(spark, monkeypatch):
    rows = list(enumerate([*texts(), "", None, " \x0b ", "a " * 5, "a " * 6, "a b " * 4, "a b " * 3 + "a", "x" * 30000]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for plant in (False, True):
        want = sorted(brute(i, t, plant) for i, t in rows)
        got = pr.find_runs(pr.planted(df) if plant else df)
        assert sorted(tuple(r) for r in got.collect()) == want
    # one round only: what is not stable is scanned as it is
    monkeypatch.setattr(pr, "MAX_ROUNDS", 1)
    assert sorted(tuple(r) for r in pr.find_runs(df).collect()) == sorted(brute(i, t) for i, t in rows)


def test_splitting_is_recursive():
    """Words that are frequent in the text and rare in a part split the part too."""
    words = np.array([1, 2, 3, 9, 1, 2, 3, 8, 1, 2, 3, 7, 1, 2, 3, 5, 5, 5, 5, 5, 5], np.uint64)
    starts, ends = pr.split(words, np.array([0, len(words)]))
    assert (starts.tolist(), ends.tolist()) == ([15], [21])


def test_clashing_hashes_are_found_out(monkeypatch):
    words = [b"a", b"b"] * 3 + [b"a"] * 3
    same = np.full(len(words), 7, np.uint64)  # as if all words had one hash
    assert pr.runs_of(same, [(0, len(words))], words) == brute_runs(words)
    w = np.array([5, 6, 5, 6, 5, 6, 5, 6, 5, 7], np.uint64)
    monkeypatch.setattr(pr, "BASE", np.uint64(0))  # sums that say nothing
    assert pr.scan(w) == [(0, 9, 2)]


def test_long_texts_take_little():
    """Hundred thousands of words in one surviving segment."""
    w = pr.mix(np.arange(200_000, dtype=np.uint64) % np.uint64(977))
    assert pr.scan(w) == [(0, 200_000, 977)]
    assert pr.scan(np.full(100_000, 3, np.uint64)) == [(0, 100_000, 1)]


def test_edges(spark, edge_docs, no_docs):
    assert pr.find_runs(pr.planted(no_docs)).count() == 0
    got = sorted((tuple(r) for r in pr.find_runs(edge_docs).collect()), key=repr)
    want = sorted((brute(r.doc_id, r.text) for r in edge_docs.where("length(text) < 50000 or text is null").collect()), key=repr)
    assert [r for r in got if r[0] not in (4, 5)] == [r for r in want if r[0] not in (4, 5)]
    assert [r[1:6] for r in got if r[0] == 5] == [(1, 0, 30000, 977, 30706)] * 2
