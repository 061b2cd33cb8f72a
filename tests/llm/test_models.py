"""Classifiers on held-out rows, kNN against brute force, and the pipeline."""

import math
import zlib

import numpy as np
import pytest

from partsnap.llm import common, exact_dedup, knn, quality, toxicity, training

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("module, label, cut", [(toxicity, "toxic", 0.5), (quality, "quality", 0.3)])
def test_held_out_accuracy(spark, module, label, cut):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    rows = {r.doc_id: r for r in module.classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    known = [(rows[r.doc_id], r[label]) for r in labels.collect() if rows[r.doc_id].held_out]
    assert len(known) >= 50
    assert np.mean([r.predicted == y for r, y in known]) >= 0.9
    assert all(r.predicted == int(r.score >= cut) and 0 <= r.score <= 1 for r in rows.values())


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_edges(spark, edge_docs, no_docs, module, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    assert module.classify(no_docs, none).count() == 0
    rows = module.classify(edge_docs, none).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    some = spark.createDataFrame([(1, 0), (3, 1), (4, 1), (5, 0), (5, 0), (7, 1), (None, 1), (9, None), (6, 0)], f"doc_id long, {label} int")
    rows = module.classify(edge_docs, some).collect()
    assert len(rows) == edge_docs.count() and all(math.isfinite(r.score) for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}


def test_toxicity_learns_from_every_segment_of_a_long_text(spark):
    rng = np.random.default_rng(7)
    clean = np.array([f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ro") for b in ("bel", "dar", "fin", "gos", "tum")])
    picked = np.linspace(0, 1999, 1024).astype(int)
    between = np.setdiff1d(np.arange(2000), picked)
    docs, labels = [], []
    for i in range(60):
        words = rng.choice(clean, 4000)
        if i % 2:
            words[2 * rng.choice(between, 12, replace=False)] = "zwqx"
        docs.append((i, " ".join(words)))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = toxicity.sampled_words(docs.selectExpr("doc_id", "0 y", "text")).collect()
    assert {len(r.words) // 8 for r in rows if r.words is not None} == {4000}
    assert len({r.word for r in rows} - {None}) == 31
    rows = toxicity.classify(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert [r.predicted for r in sorted(rows, key=lambda r: r.doc_id)] == [i % 2 for i in range(60)]


def grams_of(word):
    """Buckets of one word's n-grams, from a text of that word alone."""
    grams, _, _, size = toxicity.Subwords().read([word.encode()])
    return [int(b) for g, ok in grams for b, good in zip(g[:size], ok[:size]) if good]


def test_words_tell_the_n_grams_of_a_text(spark):
    texts = ["One two\x0b three, fOUR ", "", "a", "\u00e9t\u00c9 x" * 3, None]
    rows = toxicity.sampled_words(spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id long, y int, text string")).collect()
    listed = {r.word: bytes(r.text) for r in rows if r.word is not None}
    ids, n = toxicity.grams_of(list(listed.values()))
    known = dict(zip(listed, np.split(ids, np.cumsum(n)[:-1]), strict=True))
    for r in rows:
        if r.word is None:
            told = [int(g) for w in np.frombuffer(r.words, np.int64).tolist() for g in known[w]]
            assert sorted(told) == sorted(g for w in (texts[r.doc_id] or "").split() for g in grams_of(w))


def test_scores_by_a_plain_forward_pass(spark):
    rng = np.random.default_rng(3)
    model = (rng.normal(0, 3, toxicity.BUCKETS).astype(np.float32), -0.7)
    texts = ["one two three", "One", "", None, " \t", "x " * 501, "a bc def ghij klmno", "z" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.scored(docs, model).collect():
        words = (texts[r.doc_id] or "").split()
        bags = [[g for w in words[i : i + toxicity.SEGMENT] for g in grams_of(w)] for i in range(0, len(words), toxicity.SEGMENT)] or [[]]
        worst = max(sum(float(model[0][g]) for g in bag) / max(1, len(bag)) for bag in bags)
        assert r.score == pytest.approx(1 / (1 + math.exp(-(worst + model[1]))), abs=1e-5)


def test_one_label_only(spark):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(20)], "doc_id long, text string")
    for y in (0, 1):
        labels = spark.createDataFrame([(i, y) for i in range(20)], "doc_id long, toxic int")
        assert {r.predicted for r in toxicity.classify(docs, labels).collect()} == {y}


def test_sample_takes_a_repeated_document_once(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, None), (3, None), (4, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, 1), (4, None)], "doc_id long, toxic int")
    rows = training.sample(docs, labels, "toxic", 10).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(i, t, y) for i, t, y in [(1, "a", 0), (3, None, 1)] if zlib.crc32(str(i).encode()) % 5], key=str)


def test_harmless_keeps_columns(edge_docs, spark):
    some = spark.createDataFrame([(4, 0), (7, 1)], "doc_id long, toxic int")
    assert toxicity.harmless(edge_docs, some).columns == edge_docs.columns


def brute_knn(rows, k=10):
    vectors = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vectors:
        if q is None or q % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in vectors if i != q))
        out += [(q, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def test_knn_brute_force(spark):
    rng = np.random.default_rng(3)
    same = [0.5, -0.25, 0.125]
    rows = [(i, rng.normal(0, 1, 3).astype("f4").tolist()) for i in range(250)] + [(i, same) for i in range(250, 420)]
    rows += [(1000, None), (1001, [1.0, None, 2.0]), (1002, [float("nan"), 1.0, 1.0]), (1003, [float("inf"), 0.0, 0.0]), (None, same), (1100, same), (1200, [1.0]), (1300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in knn.knn(df, lambda v: v % 100 == 0, query_block=2, data_block=64, n_pivots=5).collect()]
    assert sorted(got, key=repr) == brute_knn(rows)
    assert knn.knn(df.limit(0), lambda v: v % 100 == 0).count() == 0


def test_knn_repeated_rows(spark):
    rows = [(100, [1.0, 0.0])] * 4 + [(i, [1.0 - i / 100, 0.0]) for i in range(1, 30)] * 2
    got = knn.knn(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda v: v % 100 == 0, k=3).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 1), (3, 2)]


def test_pipeline_stages(spark, edge_docs, no_docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    small = "/root/testdata/sf0.001"
    docs = common.table(spark, small, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, small), name)
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept[0] >= kept[1] >= kept[2] > 0
    rows = corpus_pipeline.run(spark, small).collect()
    assert sum(r.piece == 0 for r in rows) == kept[-1]
    for frame in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, small).count() >= 0
    assert exact_dedup.survivors(no_docs).count() == 0
