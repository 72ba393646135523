"""Registered queries of the package: ``(spark, sf_dir) -> DataFrame`` over
whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    chat, codes, decontam, jaccard, katz, language, lines, packing, quality, repeats, secrets, sketch, whitening)
from quarry.llm.store import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.language_model_scores(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages are identified together: pages bring markup and
    addresses, documents most of the text."""
    evidence = language.evidence_of_documents(table(spark, sf_dir, "documents")).unionByName(
        language.evidence_of_pages(table(spark, sf_dir, "pages")))
    found = language.identify(evidence)
    return found.select(
        F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"),
        F.when(F.col("kind") == "page", F.col("id")).alias("page_id"),
        "declared", "text_language", "language", "posterior", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.document_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next", "in_edited", "in_next")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256", "label")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_chat_format, op3_secret_scan, op4_ngram_jaccard, op5_katz_scores, op6_language_id, op7_decontamination,
    op8_best_fit_packing, op9_quality_rules, op10_suffix_array_dedup, op11_embedding_whitening,
    op12_document_fingerprints, op13_vector_codes)}

ORACLE_SQL = {"op2_chat_format": chat.ORACLE}
