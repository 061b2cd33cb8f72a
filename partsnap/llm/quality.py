"""Quality: random-indexing word vectors, pooled, into a two-layer network.

Random indexing gives each word of all documents a vector: the sum, over its
occurrences, of the index vectors (``NONZERO`` entries of +1 or -1 among
``DIMS``) of the words up to ``CONTEXT`` places away.  A word is a run of
letters, of digits or of other characters, hashed into ``BUCKETS`` rows, so the
table has a fixed size; tasks sum their part of the corpus, and one grouped sum
adds the parts.  Labels play no role here.

A document's features are the mean and the spread of its words' normalised
vectors and a few figures on the words' lengths and kinds.  A network with one
hidden layer is trained in numpy on a bounded sample (``PER_CLASS`` labelled
rows a class); a temperature fitted on rows it was not trained on calibrates
its probabilities.

Defined cases: null, empty and word-less texts have zero features; without
both labels to learn from, all score the share of label 1 (0.5 without any);
null doc_id is scored and not held out; repeated rows each give their row; an
empty table gives an empty result; columns other than doc_id and text are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U, Words, numbers, slices
from .training import Adam, held_out, sample, shares, sigmoid

BUCKETS = 1 << 14
DIMS = 32
NONZERO = 2
CONTEXT = 2
PER_CLASS = 2000
HIDDEN = 24
CUTOFF = 0.3
CHUNK = 1 << 20
FIGURES = 5


def classes() -> np.ndarray:
    """0 white space, 1 letters (and bytes of longer characters), 2 digits, 3 the rest."""
    kind = np.full(256, 3, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = kind[128:] = 1
    return kind


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    r = numbers(67, BUCKETS * NONZERO).reshape(BUCKETS, NONZERO)
    return (r % U(DIMS)).astype(np.int32), np.where(r >> U(63), 1.0, -1.0).astype(np.float32)


def buckets_of(words: Words, buf: np.ndarray, offsets: np.ndarray):
    starts, ends, first = words.bounds(buf, offsets)
    return (words.hashes(buf, starts, ends) >> U(64 - 14)).astype(np.int64), starts, ends, first


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The (BUCKETS, DIMS) table of all documents, normalised."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(classes())
        place, sign = index_vectors()
        table = np.zeros(BUCKETS * DIMS)
        for batch in batches:
            for _, _, buf, offsets in slices(batch.column("text"), CHUNK):
                ids, _, _, first = buckets_of(words, buf, offsets)
                owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
                for step in range(1, CONTEXT + 1):
                    near = owner[step:] == owner[:-step]
                    a, b = ids[:-step][near], ids[step:][near]
                    for j in range(NONZERO):
                        for x, y in ((a, b), (b, a)):
                            table += np.bincount(x * DIMS + place[y, j], weights=sign[y, j], minlength=BUCKETS * DIMS)
        table = table.reshape(BUCKETS, DIMS).astype(np.int64)
        rows = np.flatnonzero(table.any(axis=1))
        yield pa.record_batch([pa.array(rows, pa.int32()), *[pa.array(table[rows, d]) for d in range(DIMS)]], ["word", *[f"d{d}" for d in range(DIMS)]])

    schema = "word int, " + ", ".join(f"d{d} long" for d in range(DIMS))
    total = docs.select("text").mapInArrow(run, schema).groupBy("word").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS)]).toArrow()
    table = np.zeros((BUCKETS, DIMS))
    if total.num_rows:
        table[total.column("word").to_numpy()] = np.stack([total.column(f"d{d}").to_numpy() for d in range(DIMS)], axis=1)
    norm = np.sqrt((table**2).sum(axis=1, keepdims=True))
    return (table / np.maximum(norm, 1)).astype(np.float32)


def pooled(column: pa.Array, words: Words, vectors: np.ndarray) -> np.ndarray:
    """Features of each text."""
    out = []
    for _, _, buf, offsets in slices(column, CHUNK):
        ids, starts, ends, first = buckets_of(words, buf, offsets)
        n = np.diff(first)
        rows = np.zeros((len(n), 2 * DIMS + FIGURES))
        if len(ids):
            full = n > 0
            begin = first[:-1][full]
            v = vectors[ids]
            mean = np.add.reduceat(v, begin, axis=0) / n[full, None]
            rows[full, :DIMS] = mean
            v *= v
            rows[full, DIMS : 2 * DIMS] = np.sqrt(np.maximum(np.add.reduceat(v, begin, axis=0) / n[full, None] - mean**2, 0))
            size = (ends - starts).astype(float)
            kind = words.classes[buf[starts]]
            upper = (buf[starts] >= 65) & (buf[starts] <= 90) & (buf[ends - 1] >= 65) & (buf[ends - 1] <= 90)
            for j, x in enumerate((size, size**2, kind == 2, kind == 3, upper)):
                rows[full, 2 * DIMS + j] = np.add.reduceat(x.astype(float), begin) / n[full]
        out.append(rows)
    return np.concatenate(out) if out else np.zeros((0, 2 * DIMS + FIGURES))


def train(x: np.ndarray, y: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.01) -> dict:
    """Network, scaling and temperature; rows are weighted to the classes' shares among all labels."""
    if not len(y) or y.min() == y.max():
        return {"share": prior}
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - center) / scale
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    rng = np.random.default_rng(71)
    aside = rng.random(len(y)) < 0.2
    if y[~aside].min() == y[~aside].max() or not aside.any():
        aside[:] = False
    own = ~aside
    values = {
        "w1": rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, HIDDEN**-0.5, HIDDEN), "b2": np.zeros(1),
    }
    adam = Adam(rate)
    for _ in range(rounds):
        hidden = np.tanh(z[own] @ values["w1"] + values["b1"])
        g = (sigmoid(hidden @ values["w2"] + values["b2"]) - y[own]) * weight[own] / weight[own].sum()
        back = g[:, None] * values["w2"][None, :] * (1 - hidden**2)
        adam.step(values, {
            "w1": z[own].T @ back + 1e-4 * values["w1"], "b1": back.sum(axis=0),
            "w2": hidden.T @ g + 1e-4 * values["w2"], "b2": g.sum(keepdims=True),
        })
    model = values | {"center": center, "scale": scale, "temperature": 1.0}
    fitted = aside if aside.any() else own
    m = margin(model, x[fitted])

    def loss(t: float) -> float:
        p = np.clip(sigmoid(m / t), 1e-9, 1 - 1e-9)
        return float((-weight[fitted] * np.where(y[fitted] == 1, np.log(p), np.log(1 - p))).sum())

    model["temperature"] = min(np.geomspace(0.3, 10, 60).tolist(), key=loss)
    return model


def margin(model: dict, x: np.ndarray) -> np.ndarray:
    hidden = np.tanh((x - model["center"]) / model["scale"] @ model["w1"] + model["b1"])
    return hidden @ model["w2"] + model["b2"]


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    if "share" in model:
        return np.full(len(x), model["share"])
    return sigmoid(margin(model, x) / model["temperature"])


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs))  # BUCKETS x DIMS numbers

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(classes())
        for batch in batches:
            x = pooled(batch.column("text"), words, vectors.value)
            yield pa.record_batch([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    chosen = sample(docs, labels, label, per_class).selectExpr("cast(doc_id as long) doc_id", "cast(y as int) y", "text")
    got = chosen.mapInArrow(features, "doc_id long, y int, x array<double>").orderBy("doc_id").toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(got.num_rows, 2 * DIMS + FIGURES)
    model = train(x, got.column("y").to_numpy().astype(float), shares(docs, labels, label))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(classes())
        for batch in batches:
            p = probabilities(model, pooled(batch.column("text"), words, vectors.value))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= CUTOFF).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
