"""Toxicity: subword-bag embeddings, averaged, into a linear softmax.

A text is read in segments of ``SEGMENT`` words.  A segment's bag holds the
character n-grams (3 to 5 bytes, lower-cased A-Z, with marks at both ends of a
word) of its words, hashed into ``BUCKETS`` rows of an embedding table; their
average goes into a linear softmax, and a text scores as its worst segment.
A misspelt word shares most n-grams with the word it stands for.  Segments keep
a few words from drowning in a long text, which is still read whole.

Table and softmax are trained jointly in numpy on a bounded sample: all
segments of at most ``PER_CLASS`` labelled rows a class.  The driver holds them as
word numbers (four bytes a word) and the n-grams of each distinct word.  Rounds
first use all segments, then each text's worst one.  At scoring time the softmax of an average is the average of one
number per bucket, so a task needs one array of ``BUCKETS`` numbers.

Defined cases: null, empty and word-less texts score as an empty bag (the
model's bias, at most 0.5); without both labels to learn from, all score as the
one label says (0 without any);
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

from .common import cut
from .textops import U, Words, mix, numbers
from .training import Adam, held_out, sample, sigmoid

BUCKETS = 1 << 17
SEGMENT = 2
DIMS = 8
PER_CLASS = 1500
GRAMS = (3, 4, 5)
CHUNK = 1 << 18
BLOCK = 1 << 18  # words that training handles at a time
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class Subwords:
    """n-gram buckets and segments of a run of texts."""

    def __init__(self):
        self.values = numbers(53, 256) | U(1)
        self.white = np.zeros(256, bool)
        self.white[[9, 10, 11, 12, 13, 32]] = True
        self.values[self.white] = self.values[32]
        self.values[65:91] = self.values[97:123]
        self.weights = numbers(59, 8) | U(1)

    def read(self, texts: list[bytes]):
        """(grams, segment starts, owner): bucket arrays by n with their validity, over all bytes."""
        raw = np.frombuffer(b" " + b" ".join(texts) + b" " * 8, np.uint8)
        white = self.white[raw]
        v = self.values[raw]
        begins = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
        starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
        first = np.searchsorted(starts, np.append(begins, len(raw)))
        n = np.diff(first)
        # each text has at least one segment, empty if it has no word
        per = np.maximum(-(-n // SEGMENT), 1)
        owner = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        word = np.minimum(first[owner] + nth * SEGMENT, max(len(starts) - 1, 0))
        seg = np.where(n[owner] > 0, (starts[word] if len(starts) else np.zeros(len(owner), np.int64)) - 1, begins[owner] - 1)
        grams = []
        size = len(raw) - 8
        for k in GRAMS:
            h = np.zeros(size, U)
            for j in range(k):
                h += v[j : size + j] * self.weights[j]
            inner = white[1 : size + 1].copy()
            for j in range(2, k - 1):
                inner |= white[j : size + j]
            h = mix(h * U(k * 2 + 1))
            grams.append(((h >> U(64 - 17)).astype(np.int32), ~inner))
        return grams, seg, owner, size


def text_chunks(batch: pa.RecordBatch, limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    held, size, begin = [], 0, 0
    for i, t in enumerate(batch.column("text").cast(pa.large_binary()).to_pylist()):
        held.append(t or b"")
        size += len(held[-1])
        if size >= limit:
            yield begin, held
            held, size, begin = [], 0, i + 1
    if held:
        yield begin, held


def sampled_words(docs: DataFrame) -> DataFrame:
    """The sampled rows as packed word numbers (doc_id, y, words), and the words behind the numbers (word, text).

    An n-gram lies within one word and the white space around it, so a text is told by
    its words, and the n-grams of a word have to be found once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Words(lower=True)
        names, kinds = ["doc_id", "y", "words", "word", "text"], [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
        seen: set[int] = set()
        for batch in batches:
            told, fresh = [], {}
            for _, texts in text_chunks(batch):
                raw = np.frombuffer(b" " + b" ".join(texts), np.uint8)
                starts, ends, first = hasher.bounds(raw, np.cumsum([1, *[len(t) + 1 for t in texts]]) - 1)
                hashes = hasher.hashes(raw, starts, ends).astype(np.int64)
                told += [hashes[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                for word, i in zip(*(x.tolist() for x in np.unique(hashes, return_index=True)), strict=True):
                    if word not in seen:
                        seen.add(word)
                        fresh[word] = raw[starts[i] : ends[i]].tobytes().lower()
            n = len(told)
            yield pa.record_batch([batch.column("doc_id"), batch.column("y"), pa.array(told, kinds[2]), pa.nulls(n, kinds[3]), pa.nulls(n, kinds[4])], names)
            n = len(fresh)
            yield pa.record_batch([pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.nulls(n, kinds[2]), pa.array(list(fresh), kinds[3]), pa.array(list(fresh.values()), kinds[4])], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(y as int) y", "text").mapInArrow(run, "doc_id long, y int, words binary, word long, text binary")


def grams_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' n-grams, word after word, and how many each word has."""
    grams, _, _, size = Subwords().read(words)
    begins = np.cumsum([0, *[len(w) + 1 for w in words]])[:-1]  # the blank before each word
    owner, ids = [], []
    for g, ok in grams:
        at = np.flatnonzero(ok[:size])
        owner.append(np.searchsorted(begins, at, side="right") - 1)
        ids.append(g[at])
    owner, ids = np.concatenate(owner), np.concatenate(ids)
    return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


class Bags:
    """Segments of texts as runs of words: ``n_words`` of each bag, their places in the list of distinct words, and those words' n-grams."""

    def __init__(self, n_words: np.ndarray, words: np.ndarray, grams: np.ndarray, n_grams: np.ndarray):
        self.n_words, self.words, self.grams, self.n_grams = n_words, words, grams, n_grams
        self.first_gram = np.cumsum(n_grams) - n_grams
        self.begin = np.append(0, np.cumsum(n_words))

    def chosen(self, bags: np.ndarray) -> Bags:
        """Some of the bags, with the words they use."""
        used, words = np.unique(np.concatenate([self.words[self.begin[b] : self.begin[b + 1]] for b in bags.tolist()]), return_inverse=True)
        grams = [self.grams[a : a + k] for a, k in zip(self.first_gram[used].tolist(), self.n_grams[used].tolist(), strict=True)]
        return Bags(self.n_words[bags], words, np.concatenate([self.grams[:0], *grams]), self.n_grams[used])

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first bag, end bag, their words, the bag of each, sizes of the bags in n-grams)."""
        i = 0
        while i < len(self.n_words):
            j = max(i + 1, int(np.searchsorted(self.begin, self.begin[i] + BLOCK, side="right")) - 1)
            words = self.words[self.begin[i] : self.begin[j]]
            of = np.repeat(np.arange(j - i), self.n_words[i:j])
            yield i, j, words, of, np.bincount(of, weights=self.n_grams[words], minlength=j - i)
            i = j

    def means(self, per_bucket: np.ndarray) -> np.ndarray:
        """Average over the n-grams of each bag; 0 for an empty one."""
        per_word = np.add.reduceat(per_bucket[self.grams], self.first_gram) if len(self.n_grams) else np.zeros(0)
        out = np.zeros(len(self.n_words))
        for i, j, words, of, size in self.blocks():
            out[i:j] = np.bincount(of, weights=per_word[words], minlength=j - i) / np.maximum(size, 1)
        return out

    def back(self, g: np.ndarray, n_buckets: int) -> np.ndarray:
        """Gradient by bucket from the gradient ``g`` of each bag's average."""
        per_word = np.zeros(len(self.n_grams))
        for i, j, words, of, size in self.blocks():
            per_word += np.bincount(words, weights=(g[i:j] / np.maximum(size, 1))[of], minlength=len(per_word))
        return np.bincount(self.grams, weights=np.repeat(per_word, self.n_grams), minlength=n_buckets)


def train(y: np.ndarray, n_bags: np.ndarray, bags: Bags, rounds: int = 60, warm_up: int = 25, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """(number per bucket, bias) of the trained model; ``y`` are the texts' labels, ``n_bags`` their numbers of bags."""
    if not len(y) or y.min() == y.max():
        return np.zeros(BUCKETS, np.float32), 40.0 if len(y) and y.min() == 1 else -40.0
    y = y.astype(float)
    used, place = np.unique(bags.grams, return_inverse=True)
    bags = Bags(bags.n_words, bags.words, place, bags.n_grams)
    rng = np.random.default_rng(61)
    values = {"E": rng.normal(0, 0.1, (len(used), DIMS)), "w": rng.normal(0, 0.3, (DIMS, 2)), "b": np.zeros(2)}
    adam = Adam(rate)
    owner = np.repeat(np.arange(len(y)), n_bags)
    first_bag = np.cumsum(n_bags) - n_bags

    def margins(which: Bags) -> np.ndarray:
        return which.means(values["E"] @ (values["w"][:, 1] - values["w"][:, 0])) + values["b"][1] - values["b"][0]

    now, now_owner, weight = bags, owner, (1 / n_bags[owner]) / len(y)
    for r in range(rounds):
        if r >= warm_up and (r - warm_up) % 5 == 0:  # from now on each text's worst segment, as the model stands
            pick = np.lexsort((-margins(bags), owner))[first_bag]
            now, now_owner, weight = bags.chosen(pick), owner[pick], np.full(len(pick), 1 / len(y))
        # of the softmax's second output; the first one has the opposite gradient
        g = (sigmoid(margins(now)) - y[now_owner]) * weight
        per_bucket = now.back(g, len(used))
        dw = values["E"].T @ per_bucket
        adam.step(values, {
            "E": per_bucket[:, None] * (values["w"][:, 1] - values["w"][:, 0])[None, :] + 1e-7 * values["E"],
            "w": np.stack([-dw, dw], axis=1),
            "b": np.array([-g.sum(), g.sum()]),
        })
    out = np.zeros(BUCKETS, np.float32)
    out[used] = values["E"] @ (values["w"][:, 1] - values["w"][:, 0])
    return out, float(values["b"][1] - values["b"][0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    sampled = cut(sampled_words(sample(docs, labels, label, per_class)))
    listed = sampled.where("word is not null").groupBy("word").agg(F.min("text").alias("text")).orderBy("word").toArrow()
    known = listed.column("word").to_numpy()
    grams, n_grams = grams_of(listed.column("text").to_pylist()) if len(known) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    texts = sampled.where("word is null").select("doc_id", "y", "words").orderBy("doc_id").toArrow()
    y = texts.column("y").to_numpy(zero_copy_only=False)
    none = np.zeros(0, np.int32)
    # places in the list of words, four bytes each
    words = [np.searchsorted(known, np.frombuffer(x.as_buffer(), np.int64)).astype(np.int32) for x in texts.column("words")]
    n = np.array([len(x) for x in words], np.int64)
    n_bags = np.maximum(-(-n // SEGMENT), 1)
    n_words = np.full(int(n_bags.sum()), SEGMENT, np.int64)
    n_words[np.cumsum(n_bags) - 1] = n - (n_bags - 1) * SEGMENT
    bags = Bags(n_words, np.concatenate([none, *words]), grams, n_grams)
    del listed, texts, words
    return train(y, n_bags, bags)


def scored(docs: DataFrame, model: tuple[np.ndarray, float], keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, and the columns in ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_bucket, bias = shared.value
        reader = Subwords()
        for batch in batches:
            out = []
            for _, texts in text_chunks(batch):
                grams, seg, owner, size = reader.read(texts)
                total, count = np.zeros(size, np.float64), np.zeros(size, np.int64)
                for b, ok in grams:
                    total += np.where(ok, per_bucket[b], 0)
                    count += ok
                begin = np.minimum(seg, size - 1)
                n = np.add.reduceat(count, begin)
                mean = np.add.reduceat(total, begin) / np.maximum(n, 1)
                empty = np.array([not t.split() for t in texts])
                mean = np.where(empty[owner], 0, mean)
                out.append(np.maximum.reduceat(mean, np.searchsorted(owner, np.arange(len(texts)))))
            score = sigmoid(np.concatenate(out) + bias) if out else np.zeros(0)
            columns = [batch.column(c) for c in ("doc_id", *keep, "held_out")]
            yield pa.record_batch([*columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", *keep, "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c for c in keep if c != "text"], held_out(F.col("doc_id")).alias("held_out"))
    types = dict(rows.dtypes)
    schema = ", ".join(["doc_id long", *[f"`{c}` {types[c]}" for c in keep], "held_out boolean, score double, predicted int"])
    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    return scored(docs, fit(docs, labels, label, per_class))


def harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows not predicted to be toxic, with the columns of ``docs``."""
    columns = docs.columns
    renamed = docs.select("doc_id", "text", *[F.col(c).alias(f"_in_{c}") for c in columns if c not in ("doc_id", "text")])
    rows = scored(renamed, fit(docs, labels), keep=tuple(c for c in renamed.columns if c != "doc_id"))
    back = [F.col(c if c in ("doc_id", "text") else f"_in_{c}").alias(c) for c in columns]
    return rows.where("predicted = 0").select(*back)
