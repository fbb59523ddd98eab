"""Driver queries of the corpus operators and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from postlake.llm import decontamination, language_id, lexical, licenses, line_dedup, rank_bpe, sharding, simhash, spelling, suffix_tree, token_counts, topk, toxicity
from postlake.llm.common import held_out, table
from postlake.llm.sql import ORACLES

TOXIC_AT = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs.filter(~held_out("doc_id", 3)), table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out("doc_id", 3).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), F.size("sentences").alias("n_sentences"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = rank_bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines removed, and the digest of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text"), F.coalesce("text", F.lit("")).alias("before"))
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", F.size(F.split("before", "\n")).cast("long").alias("n_lines"), (F.octet_length("before") - F.octet_length(F.coalesce("text", F.lit("")))).cast("long").alias("bytes_removed"), F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 4, 4).select("doc_id", "fingerprint", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~held_out("doc_id", 3)))
    return language_id.identify(docs, model).select("doc_id", held_out("doc_id", 3).alias("held_out"), "lang_pred", "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 100, 10, 1024.0)


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"), 5)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), every=199, least_length=6, least_count=5, times=5)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_topk": op9_topk,
    "op10_suffix_tree": op10_suffix_tree,
    "op11_spelling": op11_spelling,
    "op12_licenses": op12_licenses,
    "op13_lexical": op13_lexical,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = ORACLES
