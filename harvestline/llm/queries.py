"""Registered queries of the operators, and their SQL where SQL can express them.

Each query applies its operator, with production parameters, to its whole
table and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.llm import (
    ann,
    decontaminate,
    hard_negatives,
    langid,
    near_dedup,
    packed_ids,
    repeats,
    resample,
    secrets,
    sentencepiece_bpe,
    substring_dedup,
    url_filter,
    warc,
)
from harvestline.llm.common import ship, table

HELD_OUT = 2  # of the four folds of crc32(doc_id)
WORD_BPE = "word_bpe_49k.json"
WORD_BPE_SIZE = 49_408
PIECE_BPE = "piece_bpe_32k.model"


def folded(docs: DataFrame) -> DataFrame:
    fold = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = folded(table(spark, sf_dir, "documents"))
    return langid.predict(spark, docs, langid.train(docs.where("not held_out")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), url_filter.train(spark))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE)
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.clustered(spark, table(spark, sf_dir, "documents"), 2)


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids.tokenised(
        spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), WORD_BPE_SIZE
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.marked(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeats_removed(spark, table(spark, sf_dir, "documents"))
    return found.drop("spans")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.deduplicated(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)


def shipped(query: Callable) -> Callable:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: shipped(f)
    for f in (
        op1_language_id,
        op2_url_filter,
        op3_sentencepiece,
        op4_near_dedup,
        op5_packed_ids,
        op6_nearest,
        op7_decontamination,
        op8_secrets,
        op9_repeats,
        op10_warc,
        op11_resampling,
        op12_substring_dedup,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op4_near_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]]
      ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh
    FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT s.sh, s.doc_id, n.n FROM s JOIN n USING (doc_id)),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM k a JOIN k b ON a.sh = b.sh AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x),
low AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.y, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(low.y, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON d.doc_id = low.x
""",
    "op6_nearest": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_reduce(list_transform(list_zip(c.e, q.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op10_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS sha,
    CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages),
g AS (SELECT sha, max(page_id) AS newest FROM p GROUP BY sha)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INTEGER)
      + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INTEGER)
      + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN p.page_id < g.newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id < g.newest THEN g.newest END AS refers_to
FROM p JOIN g USING (sha)
""",
    "op7_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s:s + 9] AS g, len(w[s:s + 9]) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, s, n, w[s:s + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT dw.doc_id, dw.s, dw.n, win.item_id FROM dw JOIN win ON dw.g = win.g AND dw.n = win.n),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS sha
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op11_resampling": r"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS crc),
words AS (
  SELECT tab, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT 's' AS tab, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)),
runs AS (
  SELECT tab, id, unnest(list_concat(w, list_concat(
    list_transform(range(1, greatest(len(w), 1)), lambda i: array_to_string(w[i:i + 1], ' ')),
    list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: array_to_string(w[i:i + 2], ' '))))) AS f
  FROM words),
grouped AS (SELECT tab, id, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(
    list_transform(range(1, 1 + octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT)),
    lambda c, b: xor(c // 256, crc[1 + xor(c % 256, b)]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT f FROM grouped), t),
feats AS (SELECT tab, id, b, sum(n) AS n FROM grouped JOIN hashed USING (f) GROUP BY ALL),
sums AS (SELECT CAST(sum(n) FILTER (tab = 's') AS DOUBLE) AS big_s, CAST(coalesce(sum(n) FILTER (tab = 't'), 0) AS DOUBLE) AS big_t FROM feats),
buckets AS (
  SELECT b, CAST(coalesce(sum(n) FILTER (tab = 's'), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (tab = 't'), 0) AS DOUBLE) AS t
  FROM feats GROUP BY b),
gains AS (
  SELECT b, CAST(floor(1000 * ln(((t + 1) * (big_s + 10000)) / ((s + 1) * (big_t + 10000)))) AS BIGINT) AS gain FROM buckets, sums),
weights AS (
  SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM feats JOIN gains USING (b) WHERE tab = 's' GROUP BY id),
scored AS (
  SELECT d.id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('42:' || d.id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5)
      / 4294967296.0))) AS BIGINT) AS score
  FROM words d LEFT JOIN weights ON d.id = weights.doc_id WHERE d.tab = 's'),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (doc_id)
""",
    "op12_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS s FROM d WHERE len(w) >= 35)),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
starts AS (SELECT doc_id, s, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS next FROM win JOIN again USING (g)),
gone AS (
  SELECT doc_id, list(p) AS gone
  FROM (SELECT doc_id, unnest(generate_series(s, least(s + 34, coalesce(next - 1, s + 34)))) AS p FROM starts) GROUP BY doc_id),
placed AS (
  SELECT d.doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d JOIN gone USING (doc_id)),
left_over AS (
  SELECT placed.doc_id, string_agg(word, ' ' ORDER BY p) AS kept
  FROM placed ANTI JOIN (SELECT doc_id, unnest(gone) AS p FROM gone) USING (doc_id, p) GROUP BY placed.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN left_over USING (doc_id)
""",
    "op13_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own,
    CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM pairs WHERE own),
ranked AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.own AND p.r <= 5
    AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score)
SELECT * FROM ranked WHERE rank <= 3
""",
}
