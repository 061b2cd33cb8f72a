"""The registered queries opN_<name> over whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup,
    hard_negatives,
    html_extract,
    knn,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
)
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.knn(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(periodic_runs.planted(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_mixing, op3_toxicity, op4_near_dedup, op5_exact_dedup,
        op6_knn, op7_quality, op8_sharding, op9_packing, op10_substring_dedup,
        op11_hard_negatives, op12_html_extract, op13_periodic_runs,
    )
}

SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, {SIZE}::BIGINT AS size, length(text) AS n, length(regexp_replace(text, '[!-@\[-`{{-~]', '', 'g')) AS plain,
         md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS h FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(h, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
            / CASE WHEN coalesce(n, 0) = 0 THEN 1.0::DOUBLE ELSE greatest(0.05::DOUBLE, plain::DOUBLE / n::DOUBLE) END AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM k GROUP BY source),
r AS (
  SELECT *, source_size * 3 AS cap, (source_size * 3)::DOUBLE / w AS ratio,
         sum(source_size) OVER () AS all_words, sum(w) OVER () AS all_w,
         sum(source_size * 3) OVER o - source_size * 3 AS cap_before, sum(w) OVER o - w AS w_before
  FROM s WINDOW o AS (ORDER BY (source_size * 3)::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT *, (all_words - cap_before)::BIGINT::DOUBLE / (all_w - w_before)::BIGINT AS level FROM r),
m AS (SELECT arg_min(level, ratio) AS level FROM l WHERE ratio > level),
t AS (
  SELECT source, source_size, CASE WHEN m.level IS NULL OR ratio <= m.level THEN cap::DOUBLE ELSE m.level * w END AS target
  FROM l, m),
p AS (
  SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(round(target)::BIGINT - epochs * source_size - before, size)))::BIGINT AS taken
FROM p
"""

OP5 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

OP4 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
walk AS (SELECT doc_id, doc_id AS node FROM documents UNION SELECT doc_id, e.b FROM walk JOIN e ON walk.node = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(walk.node) AS component_id, doc_id = min(walk.node) AS kept
FROM walk LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP11 = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_inner_product(a.e, x.e)::BIGINT AS score
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

# DuckDB has no CRC-32: its table comes from the polynomial, and a fold goes over the bytes.
OP8 = """
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b::BIGINT)) AS t),
d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS key FROM documents),
r AS (
  SELECT doc_id, key, strlen(text)::BIGINT + 16 AS size,
    xor(list_reduce(list_transform(range(1, strlen(text) + 1), lambda i: ('0x' || substr(hex(encode(text)), (2 * i - 1)::BIGINT, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32,
    list_transform(range(41), lambda j: -ln((('0x' || substr(md5(key || ':' || j), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)) AS times
  FROM d, crc),
w AS (SELECT *, list_position(times[:40], list_min(times[:40])) - 1 AS s, times[41] < list_min(times[:40]) AS moves FROM r)
SELECT doc_id, size, text_crc32, 'key' AS law, s::INTEGER AS shard,
  row_number() OVER (PARTITION BY s ORDER BY md5(key), doc_id, text_crc32, size) - 1 AS slot,
  CASE WHEN moves THEN 40 ELSE s END::INTEGER AS grown_shard
FROM w
"""

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 19], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
left_over AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

# A run has at least five equal pairs of words q apart in a row, so equal sequences of five words find them all.
OP13 = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b::BIGINT)) AS t),
o AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM documents, crc),
g AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM o),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM g),
d AS (
  SELECT doc_id, n, list_transform(range(0, n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) AS w
  FROM a),
five AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS x FROM (SELECT doc_id, w, unnest(range(0, n - 4)) AS i FROM d WHERE n >= 5)),
pair AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM five l JOIN five r ON l.doc_id = r.doc_id AND l.x = r.x AND l.i < r.i),
island AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pair)
  GROUP BY doc_id, q, part HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
run AS (SELECT doc_id, start, length, min(q) AS period FROM island GROUP BY doc_id, start, length),
total AS (
  SELECT doc_id, count(*) AS n_runs, arg_max({'s': start, 'l': length, 'q': period}, (length, -start, -period)) AS top,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS told
  FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
left_over AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(0, n)) AS i FROM d WHERE doc_id IN (SELECT doc_id FROM run)) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.l::BIGINT AS length, top.q::BIGINT AS period,
  (1000 * top.l // top.q)::BIGINT AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
  sha256(CASE WHEN n_runs IS NULL THEN array_to_string(w, ' ') ELSE t END) AS collapsed_sha256
FROM d LEFT JOIN total USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

ORACLE_SQL = {
    "op2_mixing": OP2,
    "op4_near_dedup": OP4,
    "op5_exact_dedup": OP5,
    "op6_knn": OP6,
    "op8_sharding": OP8,
    "op10_substring_dedup": OP10,
    "op11_hard_negatives": OP11,
    "op13_periodic_runs": OP13,
}
