"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, chat, exact, license, lines, minhash, packing, quality, repair,
                        shards, suffix, toxicity, whiten)
from quarry.session import ensure_checkpoint_dir

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@register("op1_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (
  SELECT doc_id, line, row_number() OVER () AS ln FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
c AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
         len(regexp_extract_all(line, '[!?]')) AS shouts,
         len(regexp_extract_all(line, '[|»›·]')) AS bars,
         regexp_matches(line, '[.!?;:,。！？…]') AS stops, lower(line) AS low FROM l),
j AS (
  SELECT *, (symbols >= 3 AND symbols * 10 > nw) OR (shouts >= 3 AND shouts * 2 > nw)
         OR (nw >= 12 AND NOT stops) OR bars >= 3
         OR regexp_replace(low, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') IN
            ('home','menu','search','login','log in','sign in','sign up','register','next','previous',
             'back','back to top','read more','click here','skip to content','share','contact',
             'contact us','about','about us','sitemap','subscribe')
         OR regexp_matches(low, 'all rights reserved|cookie policy|uses cookies|accept cookies|privacy policy|terms of use|terms of service|enable javascript|powered by|lorem ipsum|subscribe to our newsletter|sign up for our newsletter')
         AS bad FROM c),
s AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (WHERE bad) AS n_bad_lines, sum(length(line)) AS chars,
         coalesce(sum(length(line)) FILTER (WHERE bad), 0) AS removed_chars
  FROM j GROUP BY doc_id),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
k AS (SELECT doc_id, i, w[i:i+7] AS g FROM g),
f AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM k) WHERE n >= 2),
r AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8))) AS n_repeat_words FROM f GROUP BY doc_id),
b AS (
  SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
         len(regexp_extract_all(w.t, '[#*$%&|<>]')) AS n_symbols,
         coalesce(s.n_dup_lines, 0) AS n_dup_lines, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines,
         coalesce(chars, 0) AS chars, coalesce(removed_chars, 0) AS removed_chars
  FROM w LEFT JOIN s USING (doc_id) LEFT JOIN r USING (doc_id)),
z AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_bad_lines AS BIGINT) AS n_bad_lines,
       CAST(chars AS BIGINT) AS chars, CAST(removed_chars AS BIGINT) AS removed_chars,
       NOT base_failed AND removed_chars <= 0.4 * chars AS kept
FROM z
""")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).drop("clean_text") \
        .withColumnRenamed("id", "doc_id")


@register("op5_exact_dedup", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


ESCAPES = r"([<\[])(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|eot_id\|>|\|start_header_id\|>|\|end_header_id\|>|\|begin_of_text\|>|/?bos>|/?eos>|/?pad>|/?unk>|start_of_turn>|end_of_turn>|\|system\|>|\|user\|>|\|assistant\|>)"  # noqa: E501


@register("op3_chat_formatting", rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(role) + 1 + length(text) + 11
                + len(regexp_extract_all(text, '{ESCAPES}'))) AS BIGINT) AS formatted_chars,
       true AS round_trip
FROM c GROUP BY conv_id
""")
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    both = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame(
        [(-7, 0, "user", both), (-7, 1, "assistant", both)],
        "conv_id bigint, turn bigint, role string, text string"))
    done = chat.format_conversations(rows)
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return done.select(
        F.col("id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(
            x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "round_trip")


@register("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    spec = bpe.from_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)
    return bpe.round_trip_digests(documents(spark, sf_dir), spec).withColumnRenamed("id", "doc_id")


def gpt_ranks() -> tuple[bytes, str]:
    """Content of the rank file with the vocabulary of byte_bpe_50k.json, and its split pattern."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def gpt_model() -> tuple[str, None]:
    """The tokenizers model byte_bpe_50k.json, in the place of a rank file and its pattern."""
    import public_tokenizers
    return bpe.from_json(public_tokenizers.path("byte_bpe_50k.json")), None


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), *gpt_model()) \
        .withColumnRenamed("id", "doc_id")


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    held_out = F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1
    return scored.select(F.col("id").alias("doc_id"),
                         F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@register("op10_suffix_array_dedup")
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removal_report(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@register("op8_license_scan", license.oracle_sql())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@register("op8_license_texts")
def op8_license_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(documents(spark, sf_dir), templates=license.full_templates(), bare=True) \
        .withColumnRenamed("id", "doc_id")


@register("op9_token_shards")
def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{uuid.uuid4().hex}/shards"
    return shards.write_shards(documents(spark, sf_dir), *gpt_ranks(), folder) \
        .withColumnRenamed("id", "doc_id")


@register("op13_line_dedup", r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS line FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
v AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id <> v.keeper, false) AS gone FROM k LEFT JOIN v USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2("clean_text", 256).alias("kept_sha256"))


@register("op12_conversation_repair", r"""
WITH RECURSIVE
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s
  FROM conversations),
hits AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, CAST(i AS INT), 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS hit
  FROM given),
damaged AS (
  SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hits),
placed AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged),
rows_ AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?')
              THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows_ GROUP BY conv_id),
inserts(q, inserted, state, put) AS (VALUES
  (0, '', 0, []), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']),
  (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']),
  (2, '', 2, []), (2, 'I', 3, ['assistant:']), (2, 'II', 2, ['assistant:', 'user:']),
  (3, '', 3, []), (3, 'I', 2, ['user:']), (3, 'II', 3, ['user:', 'assistant:'])),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': '', 'made': []::VARCHAR[]} AS best FROM counts
  UNION ALL
  SELECT conv_id, i, e.q, min({'cost': b.cost + 3 * length(inserted) + e.cost,
                               'audit': b.audit || inserted || e.letter, 'made': b.made || put || e.put}) FROM (
    SELECT r.conv_id, r.i, w.best AS b, s.inserted, s.put, unnest(list_filter([
      {'q': s.state, 'cost': 4, 'letter': 'D', 'put': []::VARCHAR[]},
      {'q': CASE WHEN r.fault IN ('blank', 'duplicate') THEN -1 WHEN s.state = 0 AND r.initial = 's' THEN 1
                 WHEN s.state IN (0, 1, 3) AND r.initial = 'u' THEN 2
                 WHEN s.state = 2 AND r.initial = 'a' THEN 3 ELSE -1 END,
       'cost': CASE r.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'letter': 'K', 'put': [r.role || ':' || r.text]},
      {'q': CASE WHEN r.fault IN ('blank', 'duplicate') THEN -1 WHEN s.state = 2 THEN 3 ELSE 2 END,
       'cost': CASE r.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'letter': 'R',
       'put': [CASE s.state WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text]}],
      lambda e: e.q >= 0)) AS e
    FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN inserts s ON s.q = w.q)
  GROUP BY conv_id, i, e.q),
ended AS (
  SELECT w.conv_id, min({'cost': w.best.cost + 3 * length(s.inserted), 'audit': w.best.audit || s.inserted,
                         'made': w.best.made || s.put}) AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
  JOIN inserts s ON s.q = w.q AND s.state IN (0, 3) GROUP BY w.conv_id)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id
""")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair.report(repair.repair(damaged, count=F.col("n"))).withColumnRenamed("id", "conv_id")


@register("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten.whiten(vectors).withColumnRenamed("id", "vec_id") \
        .withColumn("deviation", F.col("deviation").cast("long"))
