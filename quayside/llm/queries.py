"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import fingerprints, html_text, knn, langid, lines, lm, minhash, mixing, negatives, packing, pii, repair, toxicity
from quayside.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).drop("source")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(table(spark, sf_dir, "conversations"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", noisy), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_language": op3_language,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_packing": op5_packing,
    "op6_personal_data": op6_personal_data,
    "op7_mix_sources": op7_mix_sources,
    "op8_language_model": op8_language_model,
    "op9_top_k": op9_top_k,
    "op10_main_text": op10_main_text,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_line_dedup": op12_line_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op5_packing": packing.SQL,
    "op9_top_k": knn.SQL,
    "op11_conversation_repair": repair.SQL,
    "op12_line_dedup": lines.SQL,
    "op13_hard_negatives": negatives.SQL,
}
