"""Registered queries of the corpus operators and their SQL oracles.

Each query reads its whole table, applies its operator with production parameters and
derives the digest columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import (conversation_trie, exact_dedup, fingerprint, html_text, language_id, lm, mixing, near_dedup, packing, secrets,
                           toxicity, warc, whitening)
from riskframe.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


EXACT_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  translate(coalesce(text, ''), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""


@register("op6_exact_dedup", EXACT_DEDUP_SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@register("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("value_sha256", F.sha2(F.col("value").cast("binary"), 256)).drop("value")


@register("op2_minhash_near_dedup")
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


MIXING_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(cast(doc_id AS varchar)) AS deal,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
f AS (SELECT *, sum(source_size) OVER () AS total,
             (sum(3 * source_size) OVER u) * weight
             + 3 * source_size * (sum(weight) OVER () - sum(weight) OVER u) <= (sum(source_size) OVER ()) * weight AS is_full
      FROM s WINDOW u AS (ORDER BY source_size / weight RANGE UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN is_full THEN cast(3 * source_size AS double)
                  ELSE cast(total - coalesce(sum(CASE WHEN is_full THEN 3 * source_size END) OVER (), 0) AS double) * weight
                       / (sum(CASE WHEN NOT is_full THEN weight END) OVER ()) END AS target FROM f),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.deal, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       cast(greatest(0, least(size, floor(target) - ahead)) + greatest(0, least(size, floor(target) - ahead - source_size))
            + greatest(0, least(size, floor(target) - ahead - 2 * source_size)) AS BIGINT) AS taken
FROM q
"""


@register("op7_warc_round_trip")
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register("op8_fair_queue_mixing", MIXING_SQL)
def op8_fair_queue_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.fair_queue(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op4_block_rules_html_text")
def op4_block_rules_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op3_hyperdimensional_language_id")
def op3_hyperdimensional_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


@register("op9_one_permutation_fingerprints")
def op9_one_permutation_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


@register("op10_pitman_yor_lm")
def op10_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@register("op11_weak_toxicity")
def op11_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_qdwh_whitening")
def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


TRIE_SQL = r"""
WITH RECURSIVE crc(tab) AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))),
t AS (SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS dig,
             strlen(coalesce(text, '')) AS bytes, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dig) - 1 AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS donor,
             xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
                             lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM o), crc),
l AS (SELECT c.conv_id, c.h, c.donor, least(c.h, count(o.pos)) AS taken FROM c LEFT JOIN o ON o.conv_id = c.donor GROUP BY c.conv_id, c.h, c.donor),
r AS (SELECT l.conv_id, o.pos, o.dig, o.bytes FROM l JOIN o ON o.conv_id = l.donor AND o.pos < l.h
      UNION ALL SELECT l.conv_id, o.pos - l.h + l.taken, o.dig, o.bytes FROM l JOIN o ON o.conv_id = l.conv_id AND o.pos >= l.h),
p(conv_id, depth, path, up, bytes) AS (
  SELECT conv_id, 0::BIGINT, sha256(''), NULL::VARCHAR, 0::BIGINT FROM c
  UNION ALL SELECT p.conv_id, depth + 1, sha256(path || dig), path, r.bytes FROM p JOIN r ON r.conv_id = p.conv_id AND r.pos = p.depth),
e AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
n AS (SELECT p.path, any_value(p.up) AS up, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n,
             any_value(p.bytes) AS bytes,
             sha256(coalesce(string_agg(CASE WHEN e.depth = p.depth THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id), '')) AS ends
      FROM p JOIN e ON e.conv_id = p.conv_id GROUP BY p.path),
k AS (SELECT n.*, (SELECT count(*) FROM n AS z WHERE z.up = n.path) AS kids FROM n),
u(path, above) AS (SELECT path, path FROM k UNION ALL SELECT u.path, k.up FROM u JOIN k ON k.path = u.above WHERE k.up IS NOT NULL),
s AS (SELECT u.above, sum((k.n - 1) * k.bytes) AS saved, sum((k.kids = 0)::INT) AS leaves FROM u JOIN k ON k.path = u.path GROUP BY u.above)
SELECT k.conv_id, k.depth, q.conv_id AS parent_conv_id, k.n AS n_convs, k.kids AS n_children, s.leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, k.ends AS ends_sha256
FROM k JOIN s ON s.above = k.path LEFT JOIN k AS q ON q.path = k.up
"""


@register("op13_block_hash_prefix_trie", TRIE_SQL)
def op13_block_hash_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
