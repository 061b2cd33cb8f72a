"""Each pipeline stage against a plain-Python version on the rows it gets."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from partsnap.llm import common, mixing, toxicity
from test_text_ops import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = common.table(spark, SF, "documents")
    frames = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs = common.written(stage(spark, docs, SF), f"brute-{name}")
    rows = {name: [tuple(r) for r in f.collect()] for name, f in frames.items()}
    at = frames["input"].columns.index("text")
    assert list(stages) == list(frames)[1:]

    toxic = {r.doc_id for r in toxicity.classify(frames["input"], common.table(spark, SF, "labels")).collect() if r.predicted}
    assert Counter(rows["toxicity"]) == Counter(r for r in rows["input"] if r[0] not in toxic)

    first = {}
    for r in sorted(rows["toxicity"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[at] or ""), r)
    assert sorted(rows["exact_dedup"]) == sorted(first.values())

    component = brute_components([(r[0], r[at]) for r in rows["exact_dedup"]])
    assert sorted(rows["near_dedup"]) == sorted(r for r in rows["exact_dedup"] if component[r[0]] == r[0])

    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[at] or "")) for r in rows["near_dedup"]}
    source = {r.doc_id: r.source for r in frames["near_dedup"].collect()}
    copies = Counter(r[0] for r in rows["mixing"])
    assert set(rows["mixing"]) <= set(rows["near_dedup"]) and max(copies.values()) <= 3
    words, total, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, n in size.items():
        words[source[i]] += n * copies[i]
        total[source[i]] += n
        longest[source[i]] = max(longest[source[i]], n)
    goals = spark.createDataFrame(list(total.items()), "source string, source_size long")
    for r in mixing.targets(goals).collect():
        assert abs(words[r.source] - r.target) <= longest[r.source]
        taken = [copies[i] for i in size if source[i] == r.source and size[i]]
        assert max(taken) - min(taken) <= 1  # complete epochs come before the rest

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for r in rows["mixing"]:
        ids = np.array([*tokenizer.encode(r[at] or "", add_special_tokens=False).ids, 0], "<u4")
        head = len(ids) % 2048 or min(len(ids), 2048)
        for k, s in enumerate([0, *range(head, len(ids), 2048)]):
            part = ids[s : head if k == 0 else s + 2048]
            want[(r[0], k, s, len(part), zlib.crc32(part.tobytes()))] += 1
    packed = frames["packing"].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    fill = defaultdict(list)
    for r in packed:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
