"""Hard negatives against a brute-force search, with small slabs and leaves."""

import math
import random

import numpy as np
import pytest

from partsnap.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, slab long, score long, v string, block int"


def ints(e):
    return [math.floor(256 * float(np.float32(x))) for x in e]


def brute(rows, is_anchor, positives=5, negatives=5):
    part = []
    for i, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        part.append((i, ints(e), (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    first = {}
    for i, e, label in part:
        if i is not None and is_anchor(i):
            first[i] = min(first.get(i, (label, e)), (label, e))
    out = []
    for a, (label, q) in first.items():
        scored = [(-sum(x * y for x, y in zip(q, e)), i is None, i or 0, l) for i, e, l in part if i != a]
        for s, null, i, _ in sorted(x for x in scored if x[3] == label)[:positives]:
            fit = sorted(x for x in scored if x[3] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)[:negatives]
            out += [(a, None if null else i, r, None if n else j, -s, -t) for r, (t, n, j, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, is_anchor, slab_rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).repartition(3)
    got = hn.mine(df, is_anchor, slab_rows=slab_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("slab_rows", [8192, 40])
def test_equals_brute_force(spark, monkeypatch, slab_rows):
    monkeypatch.setattr(hn, "LEAF_ROWS", 8)
    monkeypatch.setattr(hn, "FANOUT", 3)
    monkeypatch.setattr(hn, "QUERY_BLOCK", 7)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 4, 1) for _ in range(5)], rng.randrange(4)) for i in range(300)]
    rows += [(300 + i, [1.0, 1.0, 0.5, 0.0, 0.0], i % 3) for i in range(150)]  # a group of copies, all tied
    rows += [(450, [0.0] * 5, 1), (460, [1.0, 2.0], 2), (470, [], 2)]  # zeros, short and empty vectors
    rows += [(500, [1.0] * 5, None), (510, None, 1), (520, [1.0, None], 1), (530, [float("nan")], 1), (540, [float("inf")], 1)]
    rows += [(None, [1.0] * 5, 2), (None, None, None), (20, [2.0] * 5, 1), (20, [2.0] * 5, 1), (7, [2.5] * 5, 3)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 300
    assert mined(spark, rows, lambda i: i % 10 == 0, slab_rows) == want


def test_scores_beyond_doubles(spark):
    """Products over 2**53 stay exact: a tie-break depends on the last bits."""
    big = float(2**20)
    rows = [(10, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big, 1.0], 2), (3, [big, 1.0 + 1 / 256], 2), (4, [big, 2.0], 2)]
    assert mined(spark, rows, lambda i: i == 10, 8192) == brute(rows, lambda i: i == 10)


def test_empty_and_lonely(spark):
    assert mined(spark, [], lambda i: i >= 0, 8192) == []
    assert mined(spark, [(100, [1.0], 1)], lambda i: i % 100 == 0, 8192) == []
    assert mined(spark, [(100, [1.0], 1), (101, [-1.0], 1), (102, [-1.0], 2)], lambda i: i % 100 == 0, 8192) == []


def test_far_slabs_get_no_request(spark, monkeypatch):
    """Rows on a circle: the bounds leave most slabs out."""
    rows = [(i, [9 * math.cos(i * 2.4), 9 * math.sin(i * 2.4)], i % 3) for i in range(600)]
    seen = []
    routed = hn.Boxes.routed

    def spy(self, requests, dims, home):
        out = routed(self, requests, dims, home)
        if not home:
            seen.append((out.count(), requests.count() * self.count))
        return out

    monkeypatch.setattr(hn.Boxes, "routed", spy)
    anchor = lambda i: i % 100 == 0
    assert mined(spark, rows, anchor, 20) == brute(rows, anchor)
    assert len(seen) == 2 and all(asked < possible / 3 for asked, possible in seen)


def test_str_tiles_are_tight():
    x = np.random.default_rng(0).integers(0, 1000, (4096, 2))
    tree = hn.Tree(*[np.zeros(4096)] * 3, x[hn.str_order(x, hn.LEAF_ROWS)])
    assert sorted(map(tuple, tree.v)) == sorted(map(tuple, x))
    side = (tree.hi - tree.lo)[: tree.leaves].mean()
    assert side < 300  # 32 tiles of a 1000 x 1000 square have sides of about 180
    top = len(tree.first) - 1
    assert (tree.lo[top] == x.min(axis=0)).all() and (tree.hi[top] == x.max(axis=0)).all()
