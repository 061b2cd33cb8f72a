"""Exact top-k by inner product as a Voronoi kNN join.

Every vector is turned into integers and assigned to the nearest of
``n_pivots`` pivots (fixed rows, chosen by a hash of their id).  Summaries of
the cells (the k + 1 smallest distances to the pivot) give each group of
queries a score that k candidates reach for sure, by Cauchy-Schwarz:
``q.x >= q.p - |q| d(x, p)``.  The same inequality from above says which
groups a vector can matter to, ``q.x <= q.p + |q| d(x, p)``, and it is sent to
those only.  Groups of queries and the data sent to them are cut into blocks of
bounded size, whatever the size of a cell; each pair of blocks is solved by a
matrix product, and a window keeps the k best of the blocks' k best.

The driver gets the pivots and one row of bounds per group of queries, both
bounded by ``n_pivots``.

Defined cases: vectors that are null, or hold a null or non-finite component,
take no part; a shorter vector counts as padded with zeros; equal scores go
to the smaller vec_id; a query never meets rows of its own vec_id; candidate
rows that repeat a vec_id count each, a repeated query is asked once (its
smallest vector); null vec_id is a candidate (last among ties), never a query;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

K = 10
SCALE = 1024
N_PIVOTS = 24
QUERY_BLOCK = 1024
DATA_BLOCK = 8192
SLACK = 1e-6
MAX_OWN_ROWS = 1000  # beyond so many rows of one query's vec_id, all data is sent to all groups


def as_integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the components times ``scale``, rounded down, of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v")
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as int64, padded with zeros to ``dims``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(n) and (n == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(n), dims), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; through doubles (which are faster) where they hold all sums."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query row, candidate column) of the k best of each row; ``ids`` ascend, so ties go to the left."""
    low = np.iinfo(np.int64).min
    scores = np.where(own, low, scores)
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k]
        row, col = np.nonzero((scores >= least[:, None]) & ~own)
    else:
        row, col = np.nonzero(~own)
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], col[nth < k]


def knn(
    vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, n_pivots: int = N_PIVOTS,
    query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each row where ``is_query`` (a column of vec_id) holds."""
    spark = vectors.sparkSession
    ints = as_integers(vectors, scale)
    totals = ints.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not totals["n"] or not totals["dims"] and totals["n"] < 2:
        return empty
    dims = max(1, totals["dims"])
    chosen = ints.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).select("v").collect()
    pivots = np.array([[*r["v"], *[0] * (dims - len(r["v"]))] for r in chosen], np.int64).astype(np.float64)
    n_pivots = len(pivots)
    square = (pivots**2).sum(axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch.column("v"), dims)
            x = m.astype(np.float64)
            d = np.maximum(square[None, :] - 2 * (x @ pivots.T) + (x**2).sum(axis=1)[:, None], 0)
            cell = d.argmin(axis=1) if len(x) else np.zeros(0, int)
            near = ((x - pivots[cell]) ** 2).sum(axis=1) ** 0.5
            packed = pa.array([r.tobytes() for r in m], pa.binary())
            yield pa.record_batch([batch.column("vec_id"), packed, pa.array(cell, pa.int32()), pa.array(near, pa.float64())], ["vec_id", "v", "cell", "near"])

    cells = cut(ints.mapInArrow(assign, "vec_id long, v binary, cell int, near double"))
    asked = cells.where(F.col("vec_id").isNotNull() & is_query(F.col("vec_id"))).groupBy("vec_id")
    asked = asked.agg(F.min(F.struct("v", "cell")).alias("q"), F.count(F.lit(1)).alias("rows"))
    asked = cut(asked.select("vec_id", F.col("q.v").alias("v"), F.col("q.cell").alias("grp"), "rows"))
    own_rows = asked.agg(F.max("rows")).first()[0] or 0
    sure_of = k + own_rows  # so many candidates stand for k that are not the query's own rows
    nearest: list[list[float]] = [[] for _ in range(n_pivots)]
    if 0 < own_rows <= MAX_OWN_ROWS:
        closest = W.partitionBy("cell", "part").orderBy("near")
        few = (
            cells.select("cell", "near", F.spark_partition_id().alias("part"))
            .withColumn("r", F.row_number().over(closest)).where(F.col("r") <= sure_of)
            .withColumn("r", F.row_number().over(W.partitionBy("cell").orderBy("near"))).where(F.col("r") <= sure_of)
        )
        for r in few.select("cell", "near").collect():
            nearest[r["cell"]].append(r["near"])
    sure = [np.sort(np.array(x)) for x in nearest]

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each group in a batch: sure score, largest norm, largest product with each pivot, size."""
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.int64).reshape(-1, dims).astype(np.float64)
            group = batch.column("grp").to_numpy()
            dot, norm = x @ pivots.T, (x**2).sum(axis=1) ** 0.5
            reach = np.concatenate([dot[:, [j]] - norm[:, None] * s[None, :] for j, s in enumerate(sure)], axis=1)
            reach = np.sort(reach, axis=1)[:, ::-1]
            floor = reach[:, sure_of - 1] if reach.shape[1] >= sure_of else np.full(len(x), -np.inf)
            out = [(int(g), float(floor[r].min()), float(norm[r].max()), dot[r].max(axis=0).tolist(), int(r.sum())) for g in np.unique(group) for r in [group == g]]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 5, (pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64()), strict=True)],
                ["grp", "floor", "norm", "dot", "n"],
            )

    summary = asked.select("v", "grp").mapInArrow(bounds, "grp int, floor double, norm double, dot array<double>, n long")
    groups = summary.groupBy("grp").agg(
        F.min("floor").alias("floor"), F.max("norm").alias("norm"), F.sum("n").alias("n"),
        *[F.max(F.col("dot")[j]).alias(f"d{j}") for j in range(n_pivots)],
    ).collect()
    if not groups:
        return empty
    group_ids = np.array([r["grp"] for r in groups])
    floor = np.array([r["floor"] for r in groups])
    norm = np.array([r["norm"] for r in groups])
    dot = np.array([[r[f"d{j}"] for j in range(n_pivots)] for r in groups])
    query_blocks = {r["grp"]: -(-r["n"] // query_block) for r in groups}
    data_blocks = -(-totals["n"] // data_block)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each group, and block of its queries, that the vector may matter to."""
        for batch in batches:
            cell, near = batch.column("cell").to_numpy(), batch.column("near").to_numpy()
            most = dot[:, cell] + norm[:, None] * near[None, :]
            need = most + SLACK * (1 + np.abs(most)) >= floor[:, None]
            for i, g in enumerate(group_ids.tolist()):
                part = batch.select(["vec_id", "v"]).filter(pa.array(need[i]))
                for b in range(query_blocks[g] if part.num_rows else 0):
                    n = part.num_rows
                    yield pa.record_batch([*part.columns, pa.array(np.full(n, g), pa.int32()), pa.array(np.full(n, b), pa.int32())], ["vec_id", "v", "grp", "qb"])

    data = cells.select("vec_id", "v", "cell", "near").mapInArrow(wanted, "vec_id long, v binary, grp int, qb int")
    spread = F.xxhash64("vec_id", "v")
    data = data.withColumn("db", F.pmod(spread, F.lit(data_blocks)).cast("int"))
    in_group = F.create_map(*[F.lit(x) for g, n in query_blocks.items() for x in (g, n)])
    queries = asked.withColumn("qb", F.pmod(spread, in_group[F.col("grp")].cast("long")).cast("int"))
    queries = queries.withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1))))

    def solve(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        got: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            q_id = left.column("vec_id").to_numpy()
            q = np.frombuffer(b"".join(left.column("v").to_pylist()), np.int64).reshape(-1, dims)
            nulls = right.column("vec_id").is_null().to_numpy()
            x_id = right.column("vec_id").fill_null(0).to_numpy()
            x = np.frombuffer(b"".join(right.column("v").to_pylist()), np.int64).reshape(-1, dims)
            order = np.lexsort((x_id, nulls))
            x_id, nulls, x = x_id[order], nulls[order], x[order]
            for i in range(0, len(q), 128):
                scores = products(q[i : i + 128], x)
                row, col = best(scores, x_id, (q_id[i : i + 128, None] == x_id[None, :]) & ~nulls[None, :], k)
                for to, value in zip(got, (q_id[i + row], np.ma.array(x_id[col], mask=nulls[col]), scores[row, col]), strict=True):
                    to.append(value)
        arrays = [pa.array(np.ma.concatenate(g) if g else [], pa.int64()) for g in got]
        return pa.table(arrays, names=names)

    joined = queries.groupBy("grp", "qb", "db").cogroup(data.groupBy("grp", "qb", "db"))
    local = joined.applyInArrow(solve, "query_id long, vec_id long, score long")
    ranked = local.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
