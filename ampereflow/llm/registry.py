"""Queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embeddings, katz, licences, lines, oracles, packing, quality, repair, secrets, simhash, topk, toxicity, whitening
from .common import table


def op1_leaked_test_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_near_dups(table(spark, sf_dir, "embeddings"))


def op3_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_paragraphs(table(spark, sf_dir, "documents"))


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op8_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


def op12_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_leaked_test_items, op2_embedding_near_dups, op3_quality_scores, op4_katz_scores, op5_toxicity, op6_licence_paragraphs, op7_secret_spans, op8_simhash_near_dups, op9_pack_sequences, op10_repeated_lines, op11_top_products, op12_whitened_embeddings, op13_repaired_conversations)}
ORACLES: dict[str, str] = {"op2_embedding_near_dups": oracles.EMBEDDING_NEAR_DUPS, "op10_repeated_lines": oracles.REPEATED_LINES, "op11_top_products": oracles.TOP_PRODUCTS, "op13_repaired_conversations": oracles.REPAIRED_CONVERSATIONS}
