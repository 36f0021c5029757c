"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, line_dedup, mixing, near_dedup, quality, sharding, substring_dedup, suffix_dedup, suffix_tree, topk, trie, whitening
from .common import sha256_text, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op2_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark)
    return index.ingest(table(spark, sf_dir, "documents")).drop("weft_uid")


# Shares of the mix; the sources not named divide the rest equally.
MIX = {"src0": 0.2, "src1": 0.1, "src2": 0.02}
MIX_SEED = 42


@query("op5_poisson_mixing", f"""
WITH counts AS (
  SELECT source, count(*) AS n_rows,
         CASE source {" ".join(f"WHEN '{s}' THEN {w}::DOUBLE" for s, w in MIX.items())} END AS named
  FROM documents GROUP BY source),
totals AS (
  SELECT sum(n_rows) AS all_rows, count(*) FILTER (named IS NULL) AS others, coalesce(sum(named), 0) AS given FROM counts),
rates AS (
  SELECT source, 1.0::DOUBLE * all_rows
    * (coalesce(named, {1 - sum(MIX.values())!r}::DOUBLE / others)
       / (given + CASE WHEN others > 0 THEN {1 - sum(MIX.values())!r}::DOUBLE ELSE 0 END)) / n_rows AS rate
  FROM counts, totals),
sliced AS (SELECT *, greatest(1, ceil(rate / 16))::INT AS slices FROM rates),
terms AS (
  SELECT source, rate, slices, k,
         exp(-(rate / slices) + k * ln(rate / slices) - lgamma(k + 1)) AS p
  FROM sliced, range(0, 101) r(k)),
cdf AS (
  SELECT source, rate, slices, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
lists AS (SELECT source, rate, slices, list(c ORDER BY k) AS cdf FROM cdf GROUP BY ALL),
draws AS (
  SELECT doc_id, d.source, d.text, d.lang, d.n_chars, rate, cdf,
         ('0x' || substr(md5(concat_ws('|', '{MIX_SEED}', doc_id::VARCHAR, j::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source, unnest(range(0, slices)) s(j)),
copies AS (
  SELECT doc_id, source, text, lang, n_chars, rate, sum(len(list_filter(cdf, lambda c: c <= u)))::INT AS n_copies FROM draws GROUP BY ALL)
SELECT doc_id, source, text, lang, n_chars, round(rate, 6) AS rate, n_copies, copy::INT AS copy
FROM copies, unnest(range(0, n_copies)) t(copy)
""")
def poisson_mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.replicate(docs, MIX, seed=MIX_SEED).select(
        "doc_id", "source", "text", "lang", "n_chars", F.round("weft_rate", 6).alias("rate"), F.col("weft_copies").alias("n_copies"), F.col("weft_copy").alias("copy")
    )


@query("op10_kd_sharding")
def kd_sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op1_exact_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def exact_top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op7_byte_bpe")
def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS)
    digested = encoded.withColumn("ids_sha256", sha256_text(F.concat_ws(",", F.col("ids").cast("array<string>"))))
    return bpe.decode(digested, RANKS).withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


@query("op8_line_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, common.key IS NOT NULL AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark, min_docs=10, min_chars=1)
    index.insert(docs)
    return index.clean(docs).select("doc_id", "n_lines", "n_dropped", sha256_text(F.col("kept_text")).alias("kept_sha256"))


@query("op6_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 34], ' ')) AS content
  FROM d, unnest(range(1, len(words) - 33)) t(i)),
repeated AS (
  SELECT doc_id, i FROM windows WHERE content IN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1)),
words AS (SELECT doc_id, i, words[i] AS word FROM d, unnest(range(1, len(words) + 1)) t(i)),
judged AS (
  SELECT doc_id, i, word, coalesce(i - max(r.i) OVER w < 35, FALSE) AS gone
  FROM words LEFT JOIN repeated r USING (doc_id, i)
  WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))
SELECT doc_id, count(i) AS n_words, count(i) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN judged USING (doc_id) GROUP BY doc_id
""")
def substring_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeated(table(spark, sf_dir, "documents"), k=35)
    return cleaned.select("doc_id", "n_words", "n_removed", sha256_text(F.col("kept_text")).alias("kept_sha256"))


@query("op9_suffix_dedup", r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS content FROM d, unnest(range(0, len(h) // 2 - 399)) t(i)),
repeated AS (
  SELECT doc_id, i FROM windows WHERE content IN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1)),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT doc_id, i, (i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 400)::INT AS fresh FROM repeated))
  GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM runs
  UNION ALL SELECT doc_id, max(b), 1000000000 FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
removed AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
""")
def suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeated(table(spark, sf_dir, "documents"), k=400)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_near_dedup", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS s
  FROM d),
items AS MATERIALIZED (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM sets LEFT JOIN least_id USING (doc_id)
""")
def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=85).drop("weft_uid")


@query("op3_quality_classifier")
def quality_classifier_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.co_train(docs, table(spark, sf_dir, "labels")))


@query("op12_embedding_whitening")
def embedding_whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"), top=4, scale=256)
    return whitened.withColumn("deviation", F.col("deviation").cast("long"))


@query("op13_prefix_trie", """
WITH RECURSIVE ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS m,
         xor(list_reduce(
           list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT),
           lambda crc, byte: list_reduce(range(8)::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
           4294967295::BIGINT), 4294967295) % 9 AS h
  FROM ordered GROUP BY conv_id),
turns AS (
  SELECT c.conv_id, o.n, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.n < c.h
  UNION ALL
  SELECT c.conv_id, o.n + 8, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.n >= c.h),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS d,
         md5(length(role)::VARCHAR || ':' || role || text) AS turn, strlen(text) AS bytes,
         count(*) OVER (PARTITION BY conv_id) AS length
  FROM turns),
prefixes AS (
  SELECT conv_id, 0::BIGINT AS d, '' AS node, NULL::VARCHAR AS parent, 0::BIGINT AS bytes,
         NOT EXISTS (FROM placed p WHERE p.conv_id = c.conv_id) AS last FROM convs c
  UNION ALL
  SELECT p.conv_id, p.d, md5(r.node || p.turn), r.node, p.bytes, p.d = p.length
  FROM prefixes r JOIN placed p ON p.conv_id = r.conv_id AND p.d = r.d + 1),
nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, min(parent) AS parent, max(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM prefixes GROUP BY d, node),
children AS (SELECT parent, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent, d),
below AS (
  SELECT r.d, r.node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.parent = n.node AND c.d = n.d JOIN prefixes r ON r.conv_id = n.conv_id AND r.d <= n.d
  GROUP BY r.d, r.node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent AND p.d = n.d - 1 LEFT JOIN children c ON c.parent = n.node AND c.d = n.d
JOIN below b ON b.node = n.node AND b.d = n.d
""")
def prefix_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op11_suffix_tree_scores")
def suffix_tree_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", ~F.col("learned")).drop("learned")
