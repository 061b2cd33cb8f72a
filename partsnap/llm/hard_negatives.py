"""Hard negatives of anchors, by best-first search in STR-packed R-trees.

Components times ``scale``, rounded down, make integer vectors.  Rows are dealt
by tiles of their two most spread coordinates (rows that tie there by a hash) to
slabs of at most ``SLAB_ROWS`` rows; each slab is packed sort-tile-recursively
into leaves of ``LEAF_ROWS`` rows and, ``FANOUT`` by ``FANOUT``, into the boxes
above them.  A minimum bounding box gives each coordinate's product with a query an
interval, and their sums an interval for the inner product; the best-first queue
opens boxes by upper end and drops those outside the window of scores or strictly
below the k-th score found (equal ones may hold a smaller vec_id).

Two searches are made, each first in the slab of the anchor itself, whose k-th
score then bounds the other slabs: the positives of each anchor, and for every
positive the rows of other labels in its window.  Slabs that the bounds leave out
get no request.  Requests of one slab are cut into blocks of ``QUERY_BLOCK``.

The driver gets at most ``MAX_BOXES`` boxes (runs of neighbouring slabs share one
where there are more slabs); the coordinates' spread and the ends
of their slices are taken from at most ``SAMPLE`` rows, and decide about speed only.

Defined cases: rows with a null label or vector, or with a null or non-finite
component, take no part; a shorter vector counts as padded with zeros; null
vec_id is a candidate (last among ties), never an anchor, and keeps its label; an
anchor never meets rows of its own vec_id, and one that repeats is asked once
(with its smallest label and vector); positives that repeat a vec_id count each;
an empty table gives an empty result; other columns are not read.  Scores beyond
64 bits are compared exactly and returned as the nearest 64-bit number.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut
from .knn import matrix

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LABELS = 10
SLAB_ROWS = 8192
LEAF_ROWS = 128
FANOUT = 8
QUERY_BLOCK = 2048
MAX_BOXES = 4096
MAX_SLICES = 64
SAMPLE = 1024
LOW, HIGH = -(2**63), 2**63 - 1
EXACT = 2**53

SLAB = "slab long, lo array<long>, hi array<long>, n long, ids binary, nulls binary, labels binary, v binary"
REQUEST = "anchor_id long, positive_rank int, v binary, label long, low long, high long, floor long, home long"
FOUND = "anchor_id long, positive_rank int, vec_id long, label long, score long"


def as_integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label (some moved to the next one) and integer components of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    return vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def str_order(x: np.ndarray, leaf: int = LEAF_ROWS) -> np.ndarray:
    """Order of the rows in which each run of ``leaf`` rows is a tile (sort, tile, recurse on the next coordinate)."""
    n = len(x)
    leaves = -(-n // leaf)
    coordinates = np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")[: max(1, int(np.log2(max(2, leaves))))]

    def tile(rows: np.ndarray, left: list[int]) -> np.ndarray:
        pages = -(-len(rows) // leaf)
        rows = rows[np.argsort(x[rows, left[0]], kind="stable")]
        if len(left) == 1 or pages <= 1:
            return rows
        slices = int(np.ceil(pages ** (1 / len(left))))
        size = leaf * -(-pages // slices)
        return np.concatenate([tile(rows[i : i + size], left[1:]) for i in range(0, len(rows), size)])

    return tile(np.arange(n), coordinates.tolist()) if n and x.shape[1] else np.arange(n)


def most(a: np.ndarray) -> float:
    return max(abs(float(a.max(initial=0))), abs(float(a.min(initial=0))))


class Tree:
    """Rows in tiles, and boxes level by level: ``lo``, ``hi`` and the children ``first`` to ``end`` of each box (rows, for a leaf)."""

    def __init__(self, ids, nulls, labels, v):
        self.ids, self.nulls, self.labels, self.v = ids, nulls, labels, v
        starts = np.arange(0, len(v), LEAF_ROWS)
        self.lo, self.hi = [np.minimum.reduceat(v, starts)], [np.maximum.reduceat(v, starts)]
        self.first, self.end = [starts], [np.append(starts[1:], len(v))]
        self.leaves, base = len(starts), 0
        while len(self.first[-1]) > 1:
            n = len(self.first[-1])
            starts = np.arange(0, n, FANOUT)
            self.lo.append(np.minimum.reduceat(self.lo[-1], starts))
            self.hi.append(np.maximum.reduceat(self.hi[-1], starts))
            self.first.append(base + starts)
            self.end.append(base + np.append(starts[1:], n))
            base += n
        self.lo, self.hi, self.first, self.end = (np.concatenate(x) for x in (self.lo, self.hi, self.first, self.end))


def arithmetic(a: np.ndarray, b: np.ndarray) -> type | str:
    """A number type in which all inner products are exact."""
    size = most(a) * most(b) * max(1, a.shape[-1])
    return np.float64 if size < EXACT else np.int64 if size < 2.0**62 else object


def intervals(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with the boxes."""
    kind = arithmetic(q, np.stack([lo, hi]))
    up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
    lo, hi = lo.astype(kind).T, hi.astype(kind).T
    return up @ lo + down @ hi, up @ hi + down @ lo


def search(tree: Tree, anchors: list[tuple], q: np.ndarray, same: bool, k: int) -> list[tuple[int, list[tuple]]]:
    """(request, its k best rows) where ``anchors`` has (anchor_id, label, low, high, floor) of each request.

    ``same`` asks for rows of the anchor's label, else for those of other labels.
    Requests of one anchor follow each other; a leaf is scored once for them.
    """
    least, greatest = intervals(q, tree.lo, tree.hi)
    kind = arithmetic(q, tree.v)
    v, q = tree.v.astype(kind), q.astype(kind)
    root, out = len(tree.first) - 1, []
    scored: dict[int, np.ndarray] = {}
    of = None
    for r, (anchor_id, label, low, high, floor) in enumerate(anchors):
        if of is None or anchor_id != of[0] or not np.array_equal(q[r], of[1]):
            scored, of = {}, (anchor_id, q[r])
        top, bottom = greatest[r], least[r]
        found: list[tuple] = []
        kth = max(floor, low)
        queue = [(-top[root], root)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < kth:
                break  # the rest of the queue is below too
            if node >= tree.leaves:
                for child in range(tree.first[node], tree.end[node]):
                    if top[child] >= kth and bottom[child] <= high:
                        heapq.heappush(queue, (-top[child], child))
                continue
            a, b = tree.first[node], tree.end[node]
            s = scored.get(node)
            if s is None:
                s = scored[node] = v[a:b] @ q[r]
            good = (s >= kth) & (s <= high) & ((tree.labels[a:b] == label) == same) & ((tree.ids[a:b] != anchor_id) | tree.nulls[a:b])
            rows = np.flatnonzero(good)
            if len(rows):
                found += [(-int(s[i]), bool(tree.nulls[a + i]), int(tree.ids[a + i]), int(tree.labels[a + i])) for i in rows.tolist()]
                if len(found) > k:
                    found = heapq.nsmallest(k, found)
                if len(found) == k:
                    kth = max(kth, -max(found)[0])
        out.append((r, found))
    return out


def packed(vectors: DataFrame, dims: int, slabs: int, sample: np.ndarray) -> DataFrame:
    """One row per slab, its rows in the order of tiles.

    The slabs themselves are tiles of the two coordinates that ``sample`` (rows) spreads most.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SLAB.split(", ")]
        task, made = TaskContext.get().partitionId(), 0

        def slab(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            x = matrix(table.column("v"), dims)
            ids, labels = table.column("vec_id"), table.column("label").to_numpy()
            nulls, ids = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
            order = np.lexsort((ids, nulls))  # ties of a coordinate stay in the order of vec_id
            x, ids, nulls, labels = x[order], ids[order], nulls[order], labels[order]
            order = str_order(x)
            x, ids, nulls, labels = x[order], ids[order], nulls[order], labels[order]
            kind = next(t for t in (np.int16, np.int32, np.int64) if t is np.int64 or most(x) <= np.iinfo(t).max)
            number = (task << 32) + made
            row = [number, x.min(axis=0).tolist(), x.max(axis=0).tolist(), len(x), ids.astype(np.int64).tobytes(), nulls.astype(np.uint8).tobytes(), labels.astype(np.int64).tobytes(), x.astype(kind).tobytes()]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), *[pa.binary()] * 4]
            return pa.record_batch([pa.array([c], t) for c, t in zip(row, types, strict=True)], names)

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, SLAB_ROWS - n)
                held.append(part)
                at, n = at + part.num_rows, n + part.num_rows
                if n == SLAB_ROWS:
                    yield slab(held)
                    held, n, made = [], 0, made + 1
        if held:
            yield slab(held)

    wide = np.argsort(-sample.var(axis=0), kind="stable")[:2].tolist()
    slices = min(MAX_SLICES, int(np.ceil(np.sqrt(slabs)))) if len(wide) > 1 else 1
    ends = np.unique(np.quantile(sample[:, wide[0]], np.arange(1, slices) / slices)).tolist()
    first, last = (F.coalesce(F.get("v", F.lit(c)), F.lit(0)) for c in (wide[0], wide[-1]))
    slice_of = sum([(first >= F.lit(e)).cast("int") for e in ends], F.lit(0))
    order = ["slice", "at", "tie"]
    dealt = vectors.withColumns({"slice": slice_of, "at": last, "tie": F.xxhash64("vec_id", "v")}).repartitionByRange(slabs, *order).coalesce(slabs)
    return dealt.sortWithinPartitions(*order).select("vec_id", "label", "v").mapInArrow(pack, SLAB)


def slab_tree(row: dict, dims: int) -> Tree:
    n = row["n"]
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(row["v"]) // (n * dims)]
    v = np.frombuffer(row["v"], kind).reshape(n, dims).astype(np.int64)
    return Tree(ids, np.frombuffer(row["nulls"], np.uint8).astype(bool), labels, v)


def asked_in(requests: DataFrame, slabs: DataFrame, dims: int, same: bool, k: int) -> DataFrame:
    """The k best rows of each request in the slab that its column ``slab`` names."""
    names = [x.split()[0] for x in FOUND.split(", ")]

    def solve(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            tree = slab_tree(right.to_pylist()[0], dims)
            left = left.sort_by([("anchor_id", "ascending"), ("positive_rank", "ascending")])
            asked = [(r["anchor_id"], r["label"], r["low"], r["high"], r["floor"]) for r in left.drop_columns(["v"]).to_pylist()]
            q = np.frombuffer(b"".join(left.column("v").to_pylist()), np.int64).reshape(-1, dims)
            ranks = left.column("positive_rank").to_pylist()
            for r, found in search(tree, asked, q, same, k):
                rows += [(asked[r][0], ranks[r], None if null else i, label, min(HIGH, max(LOW, -s))) for s, null, i, label in found]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    wanted = requests.select(F.col("slab").alias("in_slab"), F.col("block").alias("in_block")).distinct()
    data = slabs.withColumnRenamed("slab", "tree").join(wanted, F.col("tree") == F.col("in_slab"))
    met = requests.groupBy("slab", "block").cogroup(data.groupBy("in_slab", "in_block"))
    return met.applyInArrow(solve, FOUND)


class Boxes:
    """At most ``MAX_BOXES`` boxes, each over the slabs of neighbouring tasks, on the driver; their slabs as a table."""

    def __init__(self, slabs: DataFrame):
        totals = slabs.agg(F.max(F.shiftright("slab", 32)).alias("last"), F.count(F.lit(1)).alias("n")).first()
        self.count = totals["n"]
        per = -(-(totals["last"] + 1) // MAX_BOXES)
        numbered = slabs.withColumn("box", F.expr(f"shiftright(slab, 32) div {per}"))
        self.members = numbered.select("box", F.col("slab").alias("member"))
        rows = numbered.select("box", F.posexplode(F.arrays_zip("lo", "hi")).alias("at", "b"))
        ends = rows.groupBy("box", "at").agg(F.min("b.lo").alias("lo"), F.max("b.hi").alias("hi"))
        got = ends.groupBy("box").agg(F.sort_array(F.collect_list(F.struct("at", "lo", "hi"))).alias("e")).collect()
        self.numbers = [r["box"] for r in got]
        self.lo = np.array([[x["lo"] for x in r["e"]] for r in got], np.int64)
        self.hi = np.array([[x["hi"] for x in r["e"]] for r in got], np.int64)

    def routed(self, requests: DataFrame, dims: int, home: bool) -> DataFrame:
        """Requests with a slab each: their home, or each other one that their window and floor leave."""
        names = [x.split()[0] for x in REQUEST.split(", ")]
        if home:
            out = requests.withColumn("slab", F.col("home"))
        else:
            lo, hi, numbers = self.lo, self.hi, self.numbers

            def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    q = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.int64).reshape(-1, dims)
                    low, high, floor = (np.array(batch.column(c).to_pylist(), object) for c in ("low", "high", "floor"))
                    least, greatest = intervals(q, lo, hi)
                    need = ((greatest >= np.maximum(low, floor)[:, None]) & (least <= high[:, None])).astype(bool)
                    for b, number in enumerate(numbers):
                        part = batch.filter(pa.array(need[:, b]))
                        if part.num_rows:
                            yield pa.record_batch([*part.columns, pa.array([number] * part.num_rows, pa.int64())], [*names, "box"])

            out = requests.select(*names).mapInArrow(route, f"{REQUEST}, box long").join(self.members, "box").where("member <> home")
            out = cut(out.select(*names, F.col("member").alias("slab")))
        # blocks of one slab: by a hash of the anchor, so that requests of one anchor stay together
        load = out.groupBy("slab").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
        return out.join(load, "slab").withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.col("blocks"))).drop("blocks")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def both_rounds(requests: DataFrame, slabs: DataFrame, boxes: Boxes, dims: int, same: bool, k: int) -> DataFrame:
    """The k best rows of each request: first in its home slab, then wherever a better one may be."""
    near = cut(asked_in(boxes.routed(requests, dims, True), slabs, dims, same, k))
    if boxes.count == 1:
        return ranked(near, k)
    kth = ranked(near, k).where(F.col("rank") == k).select("anchor_id", "positive_rank", F.col("score").alias("kth"))
    bounded = requests.join(kth, ["anchor_id", "positive_rank"], "left")
    bounded = bounded.withColumn("floor", F.greatest("floor", F.coalesce("kth", "floor"))).drop("kth")
    far = asked_in(boxes.routed(bounded, dims, False), slabs, dims, same, k)
    return ranked(near.unionAll(far), k)


def mine(
    vectors: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
    slab_rows: int = SLAB_ROWS, lower: int = 80, upper: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores.

    Anchors are rows whose vec_id meets ``is_anchor`` (a column of vec_id).  Negatives
    score from ``lower`` to ``upper`` percent (0 <= lower < upper <= 100) of the
    positive's score, so a positive with a negative score has none.
    """
    spark = vectors.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    ints = as_integers(vectors, scale)
    totals = ints.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    if not totals["n"]:
        return spark.createDataFrame([], out)
    dims = max(1, totals["dims"])
    few = ints.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).select("v").collect()
    sample = matrix(pa.array([r["v"] for r in few], pa.list_(pa.int64())), dims).astype(np.float64)
    slabs = cut(packed(ints, dims, -(-totals["n"] // slab_rows), sample))
    boxes = Boxes(slabs)

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = slab_tree(row, dims)
                at = np.flatnonzero(~t.nulls)
                packed_rows = [t.v[i].tobytes() for i in at.tolist()]
                yield pa.record_batch(
                    [pa.array(t.ids[at], pa.int64()), pa.array(t.labels[at], pa.int64()), pa.array(packed_rows, pa.binary()), pa.array([row["slab"]] * len(at), pa.int64())],
                    ["vec_id", "label", "v", "home"],
                )

    rows = slabs.mapInArrow(anchors_of, "vec_id long, label long, v binary, home long").where(is_anchor(F.col("vec_id")))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v", "home")).alias("a"))
    everything = [F.lit(LOW).alias("low"), F.lit(HIGH).alias("high"), F.lit(LOW).alias("floor")]
    asked = cut(rows.select(F.col("vec_id").alias("anchor_id"), F.lit(0).alias("positive_rank"), "a.v", "a.label", *everything, "a.home"))

    found = both_rounds(asked, slabs, boxes, dims, True, positives)
    pairs = cut(found.select("anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # lower * score and upper * score in hundreds, without leaving 64 bits
    hundreds, rest = "positive_score div 100", "positive_score % 100"
    windows = pairs.where("positive_score >= 0").selectExpr(
        "anchor_id", "positive_rank",
        f"{lower} * ({hundreds}) + ({lower} * ({rest}) + 99) div 100 as low",
        f"{upper} * ({hundreds}) + ({upper} * ({rest})) div 100 as high",
    )
    requests = cut(windows.join(asked.drop("positive_rank", "low", "high"), "anchor_id").select(*[x.split()[0] for x in REQUEST.split(", ")]))
    chosen = both_rounds(requests, slabs, boxes, dims, False, negatives)
    return chosen.join(pairs, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
