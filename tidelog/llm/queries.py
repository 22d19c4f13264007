"""The operators over their whole tables, as registered queries, and their results as SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import conversation_trie, decontaminate, lm_scoring, near_dup, packing, preference_quality, quality, secrets_scan, spelling, suffix_dedup
from tidelog.llm import token_counts, url_filters, warc

RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), url_filters.rules_of(spark, RULES))


OP1_SQL = """
WITH rules(rule_host, rule_path, action) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM cut),
judged AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path, row_number() OVER () AS k FROM parts),
best AS (
  SELECT k, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(action, length(rule_host || rule_path)) AS action
  FROM judged JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM judged LEFT JOIN best USING (k)
"""


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "representative")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scan(table(spark, sf_dir, "documents")).filter("is_secret")
    return found.select("doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("secret_sha256"), "probability")


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"))).drop("content")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), WORD_BPE)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(table(spark, sf_dir, "conversations"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    return preference_quality.judge(table(spark, sf_dir, "documents"), labels).withColumn("held_out", held_out)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: value for name, value in globals().items() if name.startswith("op") and callable(value)}


def all_expected() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL}
