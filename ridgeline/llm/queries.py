"""The operators of this subpackage bound to the tables, and SQL for those
that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import (exact_dedup, jaccard_join, language_id, merkle, packing, piece_codec, pii, prefix_trie,
                           quality_classifier, quality_rules, token_counts, tool_calls, word_bpe)
from ridgeline.llm.common import located, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.from_conversations(table(spark, sf_dir, "conversations"))
    schemas = spark.sql(
        "SELECT * FROM VALUES " + ", ".join(str(s) for s in tool_calls.SCHEMAS) + " AS t(name, param, type, required)")
    events = tool_calls.link_tool_calls(calls, results, schemas)
    return events.withColumn("errors", F.array_join("errors", " "))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("clean_text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = located(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return exact_dedup.decisions(rows).drop("file", "row")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_decode(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_token_counts, op3_tool_calls, op4_quality_rules, op5_best_fit_packing,
    op6_exact_dedup, op7_personal_data, op8_jaccard_join, op9_word_bpe, op10_language_id,
    op11_merkle_manifest, op12_piece_codec, op13_prefix_trie)}

ORACLE: dict[str, str] = {
    "op3_tool_calls": tool_calls.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op4_quality_rules": f"SELECT * EXCLUDE (clean_text) FROM ({quality_rules.oracle_sql()})",
    "op11_merkle_manifest": merkle.oracle_sql(),
    "op13_prefix_trie": prefix_trie.oracle_sql(),
}
