"""Secret scan, near dedup, packing and substring dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from partsnap.llm import near_dedup, packing, secret_scan, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWD", "toKen", "token", "api_key", "secret", "=", ":", " ", "'", '"', "AKIA", "abc", "0123456789abcdef", "ABCDEFGH12", "ſecret", "é"]), max_size=20))
def test_base_spans_equal_brute_force(parts):
    assert secret_scan.base_spans("".join(parts)) == brute_base("".join(parts))


def test_random_spans_leave_out_what_base_spans_touch():
    hit = "aB3" * 8
    text = " ".join([hit, "0" * 30, hit, "x", hit])
    at = [m.start() for m in re.finditer(hit, text)]
    base = [(0, 0, 2), (30, 2, 40), (at[2] + 5, 1, at[2] + 6)]
    got = secret_scan.random_spans(text, len, base, 2.0)
    brute = [(a, 3, a + 24) for a in at if not any(x < a + 24 and a < y for x, _, y in base)]
    assert got == brute == [(at[1], 3, at[1] + 24)]


def test_secret_scan(spark, edge_docs, no_docs):
    assert secret_scan.scan(no_docs).count() == 0
    rows = secret_scan.scan(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].base_sha256 == hashlib.sha256(b"").hexdigest() and by_id[1].spans == ""
    assert (by_id[8].n_assign, by_id[8].n_access, by_id[8].n_hex) == (1, 1, 1)
    key = "q7Zt9LmX2vBn8RkP4wYs6HdJ3f"
    texts = [(1, f"the key {key} here"), (2, "commit 9fceb02d0ae598e95dc970b74767f19372d61af8"), (3, "internationalization_of_configuration_values"), (4, "id 123e4567-E89B-12d3-a456-426614174000")]
    found = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found[1].spans == f"random:8:{8 + len(key)}"
    assert [found[i].n_random for i in (2, 3, 4)] == [0, 0, 0] and found[2].n_hex == 1


def test_random_keys_of_any_kind_of_characters_are_found(spark):
    rng = random.Random(3)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    keys = ["".join(rng.choices(kind, k=n)) for kind in (lower + digits, upper + digits, upper + "234567", digits + "ABCDEF", lower + upper, lower, upper) for n in (26, 36)]
    known = ["4111-1111-1111-1111-1111", "12_34/56=78+90-12_34_56", "=" * 40, "A0" * 20, "123E4567-E89B-12D3-A456-426614174000", "internationalization_of_configuration_values"]
    docs = spark.createDataFrame(list(enumerate(f"the key {k}, here" for k in keys + known)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secret_scan.scan(docs).collect()}
    assert [found[i] for i in range(len(keys))] == [f"random:8:{8 + len(k)}" for k in keys]
    assert [found[len(keys) + i] for i in range(len(known))] == [""] * len(known)


def test_random_keys_among_words_and_next_to_base_spans_are_found(spark):
    rng = random.Random(4)
    both = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = ["/home/projects/services/documents/archive/", "production/database/connection/", "customer-service-authentication-"]
    access, digest, uuid = "AKIA" + "Q7" * 8, "9F" * 20, "123e4567-E89B-12d3-a456-426614174000"
    texts, want = [], []
    for before, after in [("".join(words), "/documents/archive/production"), (words[1] * 3, "/services"), (access + "/", ""), (access + "/", "=" + access), (digest + "_", ""), (uuid + "-", "/" + "ab" * 12)]:
        key = "".join(rng.choices(both, k=40))
        texts.append(f"see {before}{key}{after}.")
        want.append((4 + len(before), 44 + len(before)))
    texts += [f"{words[0]}{digest}/{uuid}", f"{access}/{words[0]}", access + "lowercase/" + digest]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("random")] for r in secret_scan.scan(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [[w] for w in want] + [[]] * 3


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            c = len(a & b)
            if c and 100 * c >= 85 * (len(a) + len(b) - c):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_near_dedup_edges(edge_docs, no_docs):
    assert near_dedup.near_dedup(no_docs).count() == 0
    docs = [(d.doc_id, d.text) for d in edge_docs.collect()]
    want = brute_components(docs)
    rows = near_dedup.near_dedup(edge_docs).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.doc_id == want[r.doc_id])
    assert {(r.doc_id, r.n_shingles) for r in rows if r.doc_id} == {(i, len(shingles(t))) for i, t in docs if i}
    assert near_dedup.survivors(edge_docs).columns == edge_docs.columns


def test_survivors_of_ids_with_several_texts(spark):
    words = [f"w{i}" for i in range(60)]
    t1, near, other = " ".join(words), " ".join([*words[:-1], "x"]), "a text of its own that nothing is like"
    rows = [(3, t1, 0), (7, near, 1), (7, other, 2), (7, other, 3), (8, t1, 4), (9, "", 5), (9, None, 6), (9, "one", 7), (None, t1, 8), (5, other + " but one word", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, nth int")
    assert sorted(r.nth for r in near_dedup.survivors(docs).collect()) == [0, 2, 3, 5, 6, 7, 8, 9]
    assert near_dedup.survivors(docs).columns == docs.columns
    both = spark.createDataFrame([(1, t1), (1, near), (2, near)], "doc_id long, text string")
    assert len(near_dedup.survivors(both).collect()) == 1


def test_near_dedup_finds_every_link_of_edited_copies(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for copies in (3, 30, 150):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(8)):
                at = rng.randrange(len(t))
                t[at : at + rng.choice([0, 1, 1, 1])] = [rng.choice(vocabulary)]
            texts.append(" ".join(t))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def test_near_dedup_of_members_unlike_their_hub(spark):
    """Texts of one template that share from a quarter to nine tenths of their words."""
    rng = random.Random(7)
    template = [f"t{i}" for i in range(100)]
    texts = []
    for i in range(160):
        own = [f"o{i}x{j}" for j in range(rng.choice([10, 40, 90]))]
        variant = template[: rng.choice([60, 100])] + own
        texts.append(" ".join(variant))
        for j in range(rng.choice([0, 0, 1, 2])):
            texts.append(" ".join([*variant[: rng.randrange(len(variant) - 4, len(variant) + 1)], f"e{i}y{j}"]))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def test_near_dedup_compares_few_texts_of_one_template(spark, monkeypatch):
    """Similar to 0.45 with words of their own: nothing to link, and pairs grow with the documents, not with their square."""
    template = " ".join(f"t{i}" for i in range(102))
    pairs, compared = [], near_dedup.compared

    def counted(rows, texts):
        pairs.append(rows.count())
        return compared(rows, texts)

    monkeypatch.setattr(near_dedup, "compared", counted)
    totals = []
    for n in (500, 1000):
        pairs.clear()
        docs = spark.createDataFrame([(i, template + " " + " ".join(f"o{i}x{j}" for j in range(60))) for i in range(n)], "doc_id long, text string")
        assert near_dedup.near_dedup(docs).where("kept").count() == n
        totals.append(sum(pairs))
    assert totals[0] < 40 * 500 and totals[1] < 2.5 * totals[0]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=12))
def test_plan_places_every_piece_once(counts):
    lines = packing.plan(counts, 64)
    placed, fill = defaultdict(list), defaultdict(int)
    for length, first, times, base, offset in sorted(lines, key=lambda x: x[4]):
        placed[length] += range(first, first + times)
        for s in range(base, base + times):
            assert fill[s] == offset
            fill[s] += length
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert all(v <= 64 for v in fill.values())


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 4), max_size=8), st.integers(1, 63))
def test_exact_fill_finds_a_combination_if_there_is_one(counts, gap):
    have = np.zeros(65, np.int64)
    for k, n in counts.items():
        have[k] = n
    found = packing.exact_fill(have.copy(), gap)
    bag = [k for k, n in counts.items() for _ in range(n)]
    exists = any(sum(c) == gap for n in (1, 2, 3) for c in combinations(bag, n)) if len(bag) <= 16 else None
    if found:
        assert sum(found) == gap and all(found.count(x) <= counts.get(x, 0) for x in found)
    if exists is not None:
        assert bool(found) == exists


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_tokenizers_library(text):
    global ENCODING, TOKENIZER
    if "ENCODING" not in globals():
        path = public_tokenizers.path("byte_bpe_50k.json")
        ENCODING, TOKENIZER = packing.load_encoding(path, public_tokenizers.PATTERN), Tokenizer.from_file(path)
        TOKENIZER.encode_special_tokens = True
    assert ENCODING.encode_to_numpy(text, disallowed_special=()).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_packing_ids_are_those_of_the_default_tokenizer(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [f"abc {end} def", end, end * 3 + " ", f"<|{end}|>", "<|endoftext|", "\n" * 99_999 + "x", "y" + " " * 1_100_000 + "x", "\u3000\n" * 550_000, " " * 1_100_000 + end]
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert 50256 in want[0] and len(want[0]) == 5
    encode = packing.load_ids(path, public_tokenizers.PATTERN)
    assert all([*encode(t).tolist(), 0] == want[i] for i, t in enumerate(texts))
    found = defaultdict(int)
    for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        part = want[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        found[r.doc_id] += r.length
    assert found == {i: len(x) for i, x in want.items()}


def test_packing_round_trip(spark, edge_docs, no_docs):
    assert packing.pack(no_docs).count() == 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    ids = {d.doc_id: [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0] for d in docs.collect()}
    rows = packing.pack(docs).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for doc_id, parts in pieces.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[2] for p in parts) == len(ids[doc_id])
        assert all(p[2] == 2048 for p in parts[1:])
    assert packing.pack(edge_docs).where("doc_id = 5 and piece = 0").count() == 2


def brute_repeats(rows, window):
    words = {i: WORD.findall(t or "") for i, t in rows if i is not None}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p : p + window]), (i, p))
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] != (i, p):
                gone.update(range(p, p + window))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def test_substring_dedup(spark, edge_docs, no_docs, monkeypatch):
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    rng = random.Random(9)
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(i, " ".join([*[f"w{rng.randrange(6)}" for _ in range(rng.randrange(60))], common if i % 3 else "", "a a a a " * (i % 7), f"t{i % 5} " * 9])) for i in range(60)]
    rows += [(d.doc_id, d.text) for d in edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).selectExpr("doc_id + 1000 doc_id", "text").collect()]
    want = brute_repeats(rows, 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for _ in range(2):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs).collect()}
        assert got == want
        # once more with every minimiser counted as hot: all windows travel alone
        monkeypatch.setattr(substring_dedup, "hot_cells", lambda *a: np.arange(1 << 16, dtype=np.uint64))
    assert substring_dedup.remove_repeats(edge_docs).count() == edge_docs.count()
