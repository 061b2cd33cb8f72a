"""Mixing, exact dedup and sharding: edge cases, and Spark-only plans."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from partsnap.llm import common, exact_dedup, mixing, sharding


def test_targets_reshare_until_none_is_above(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 300, "d": 0}
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    order = [*sorted(k for k in sizes if k is not None), None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    want, total = {}, sum(sizes.values())
    while True:
        free = [k for k in sizes if k not in want]
        level = (total - sum(want.values())) / sum(weight[k] for k in free)
        over = [k for k in free if level * weight[k] > 3 * sizes[k]]
        if not over:
            want |= {k: level * weight[k] for k in free}
            break
        want |= {k: 3.0 * sizes[k] for k in over}
    assert got == pytest.approx(want)


def test_mix_edges(edge_docs, no_docs):
    assert mixing.mix(no_docs).count() == 0
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    for k in taken:
        assert abs(taken[k] - target[k]) <= 1
    again = mixing.mix(edge_docs.repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mix_materialised(edge_docs):
    out = mixing.materialise(edge_docs)
    assert out.columns == edge_docs.columns
    known = {r for r in map(tuple, edge_docs.collect())}
    rows = [tuple(r) for r in out.collect()]
    assert set(rows) <= known and max(Counter(rows).values()) <= 6


def test_exact_dedup_edges(edge_docs, no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    for fan_in in (2, 16):
        rows = exact_dedup.exact_dedup(edge_docs.repartition(7), fan_in).collect()
        groups = defaultdict(list)
        for d in edge_docs.collect():
            groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", d.text or "").encode()).hexdigest()].append(d.doc_id)
        assert len(rows) == edge_docs.count()
        for r in rows:
            ids = groups[r.text_sha256]
            assert r.group_size == len(ids) and r.doc_id in ids
            assert r.keep_id == min((i for i in ids if i is not None), default=None)
        kept = Counter(r.text_sha256 for r in rows if r.kept)
        assert set(kept.values()) == {1} and set(kept) == set(groups)
    out = exact_dedup.survivors(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == len(groups)


def test_sharding_edges(edge_docs, no_docs):
    assert sharding.shard(no_docs).count() == 0
    rows = sharding.shard(edge_docs, slice_rows=1).collect()
    assert len(rows) == edge_docs.count()
    texts = Counter((d.doc_id, zlib.crc32((d.text or "").encode()), len((d.text or "").encode()) + 16) for d in edge_docs.collect())
    assert texts == Counter((r.doc_id, r.text_crc32, r["size"]) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_follows_weights_and_moves_little(spark):
    docs = spark.range(8000).selectExpr("id doc_id", "'t' text")
    rows = sharding.shard(docs, weights=(1.0, 2.0, 1.0), added=1.0).collect()
    share = Counter(r.shard for r in rows)
    assert abs(share[1] / 8000 - 0.5) < 0.03
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert all(r.grown_shard == 3 for r in moved) and abs(len(moved) / 8000 - 0.2) < 0.03


def test_native_plans(edge_docs):
    for df in (mixing.mix(edge_docs), exact_dedup.exact_dedup(edge_docs), sharding.shard(edge_docs)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_merges_are_one_pass_over_sorted_runs(spark):
    """A round moves entries once and merges neighbours: no exchange between its sort and its aggregate."""
    docs = spark.range(40).selectExpr("id doc_id", "concat('t', id % 7) text").repartition(5)
    _, root = exact_dedup.merge_rounds(exact_dedup.digests(docs))
    plan = root._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 3  # five runs: three binomial rounds
    assert len(re.findall(r"SortAggregate[^\n]*\n[^\n]*SortAggregate[^\n]*\n[^\n]*Sort \[", plan)) == 3
    assert root.count() == 7 and {r.n_rows for r in root.collect()} == {5, 6}
    first, _ = exact_dedup.merge_rounds(exact_dedup.digests(docs))
    runs = defaultdict(list)
    for r in first.collect():
        runs[r.run].append((r.range, bytes(r.sha)))
    assert all(x == sorted(x) for x in runs.values()) and len(runs) == 5


def test_weight_moves_what_is_taken(spark):
    """Documents of signs and digits have a low weight and are taken less often, as often as the model says."""
    n = 4000
    docs = spark.range(n).selectExpr("id doc_id", "if(id % 2 = 0, 'plain words here', '12 -- 34 word') text", "'a' source")
    docs = docs.unionByName(spark.range(3 * n).selectExpr("id + 100000 doc_id", "'other words here' text", "'b' source"))
    weights = {r[0]: r[1] for r in docs.where("source = 'a'").select("text", mixing.quality_weight(docs["text"])).distinct().collect()}
    assert weights == {"plain words here": 1.0, "12 -- 34 word": pytest.approx(7 / 13)}
    rows = mixing.mix(docs, weights=(1, 11)).where("source = 'a'").collect()  # a third of the words of source a
    kept = Counter((r.doc_id % 2, r.taken > 0) for r in rows)
    share = [kept[i, True] / (n / 2) for i in (0, 1)]
    assert share[0] > 1.4 * share[1] and 0.3 < sum(share) / 2 * 1.0 < 0.4


@pytest.mark.parametrize("weight", [1.0, 0.05, 1e-6])
def test_slices_are_even_at_every_weight(spark, weight):
    from pyspark.sql import functions as F

    n = 20000
    keys = spark.range(n).select((-F.log(mixing.unit_hash(F.col("id").cast("string"))) / weight).alias("k"))
    sizes = [r["count"] for r in keys.groupBy(F.floor(F.log2("k") * mixing.SLICES)).count().collect()]
    assert max(sizes) < n / 500


def test_rows_without_ids_do_not_share_a_slice(spark):
    docs = spark.range(2000).selectExpr("cast(null as long) doc_id", "concat('word ', id) text", "'a' source")
    rows = mixing.mix(docs).collect()
    assert sum(r.taken for r in rows) == 4000 and len(rows) == 2000


def test_cut_that_drops_shuffles_has_the_same_rows_and_leaves_the_setting(spark):
    before = spark.conf.get(common.DROP_SHUFFLES)
    rows = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    kept, dropped = common.cut(rows), common.cut(rows, drop_shuffles=True)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, dropped.collect())) == sorted(map(tuple, rows.collect()))
    assert spark.conf.get(common.DROP_SHUFFLES) == before
