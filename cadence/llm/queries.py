"""The registered queries of the operators, each over its whole table, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import (
    byte_bpe, embeddings, fill_middle, jaccard_forest, packing, quality, sharding, substring, swap_packing, token_blocks,
    toxicity, url_filter, whitening,
)
from cadence.llm.common import new_path, table

#: Where the public vocabulary files are; a parameter of the operators.
TOKENIZERS = os.path.dirname(public_tokenizers.path("README.md"))


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_blocks.write_tokens(table(spark, sf_dir, "documents"), path, os.path.join(TOKENIZERS, "byte_bpe_50k.json"))
    return token_blocks.token_digests(spark, path)


def op2_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_forest.join_report(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos, len(ws) AS n FROM texts
), grams AS (
  SELECT doc_id, n, pos, count(*) OVER w AS size, string_agg(word, ' ') OVER w AS gram
  FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), sets AS (
  SELECT DISTINCT doc_id, gram FROM grams WHERE size = 5 OR (n < 5 AND pos = 1)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE shared / (x.n + y.n - shared) >= 0.8
  UNION
  SELECT x.doc_id, y.doc_id FROM texts x JOIN texts y ON x.text = y.text AND x.doc_id <> y.doc_id
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM texts
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), found AS (
  SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a
)
SELECT doc_id, class_id, coalesce(n, 0) AS n_links, doc_id = class_id AS kept
FROM found LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a) USING (doc_id)
"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM texts
), windows AS (
  SELECT doc_id, pos, word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS next_word,
         CASE WHEN count(*) OVER w = 8 THEN string_agg(word, ' ') OVER w END AS span
  FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), repeated AS (
  SELECT *, CASE WHEN span IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, span) > 1 THEN 1 ELSE 0 END AS again
  FROM windows
), covered AS (
  SELECT doc_id, word, next_word,
         max(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit
  FROM repeated
), counts AS (
  SELECT doc_id, sum(hit) AS n_repeat_words, sum(length(word)) AS word_chars,
         sum(CASE WHEN word = next_word THEN 1 ELSE 0 END) AS n_stutter,
         sum(CASE WHEN list_contains(string_split('STOP_WORDS', ' '), word) THEN 1 ELSE 0 END) AS n_stop_words
  FROM covered GROUP BY doc_id
), measures AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(ls) AS n_lines, coalesce(n_stutter, 0) AS n_stutter, coalesce(n_stop_words, 0) AS n_stop_words
  FROM texts LEFT JOIN counts USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(n_stutter AS BIGINT) AS n_stutter, CAST(n_stop_words AS BIGINT) AS n_stop_words, base_failed,
       NOT base_failed AND n_symbols <= 0.1 * n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
         AND n_dup_lines <= 0.5 * n_lines AND n_stutter <= 0.25 * n_words
         AND (n_words < 200 OR n_stop_words >= 0.005 * n_words) AS kept
FROM judged
""".replace("STOP_WORDS", " ".join(quality.STOP_WORDS))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_report(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), os.path.join(TOKENIZERS, "word_bpe_49k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_report(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM texts
), windows AS (
  SELECT doc_id, pos, word,
         CASE WHEN count(*) OVER w = 35 THEN string_agg(word, ' ') OVER w END AS span
  FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), repeated AS (
  SELECT span FROM windows WHERE span IS NOT NULL GROUP BY span HAVING count(*) > 1
), covered AS (
  SELECT doc_id, pos, word,
         max(CASE WHEN r.span IS NULL THEN 0 ELSE 1 END)
           OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM windows LEFT JOIN repeated r ON windows.span = r.span
), kept AS (
  SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept
  FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


OP9_SQL = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE x.usable AND y.usable AND list_cosine_similarity(x.v, y.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), found AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM found LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), hashed AS (
  SELECT *, CAST('0x' || substr(digest, 1, 8) AS UBIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS UBIGINT) AS h2,
         CAST('0x' || substr(digest, 17, 8) AS UBIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS UBIGINT) AS h4
  FROM texts
), formed AS (
  SELECT doc_id, text, n, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS low,
         CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS high,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), parts AS (
  SELECT *, substr(text, 1, low) AS prefix, substr(text, low + 1, high - low) AS middle, substr(text, high + 1) AS suffix
  FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def op13_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.packed(table(spark, sf_dir, "documents"), os.path.join(TOKENIZERS, "byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_blocks": op1_token_blocks,
    "op2_jaccard_forest": op2_jaccard_forest,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_sharding": op6_sharding,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_embeddings": op9_embeddings,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_fill_middle": op12_fill_middle,
    "op13_swap_packing": op13_swap_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op2_jaccard_forest": OP2_SQL,
    "op3_quality_rules": OP3_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_embeddings": OP9_SQL,
    "op12_fill_middle": OP12_SQL,
}
