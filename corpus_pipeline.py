"""A training-corpus pipeline over ``documents``.

Five stages, each the work of one operator on all that the stage before kept;
each result is written as Parquet below the shared checkpoint folder and read
again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import decontamination, language_id, line_dedup, rank_bpe, simhash
from postlake.llm.common import held_out, materialize, table

#: A document whose language is less sure than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language; those without a letter or a clear language go."""
    model = language_id.train(docs.filter(~held_out("doc_id", 3)))
    return language_id.keep_identified(docs, model, LEAST_LANGUAGE_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that match an earlier one; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs, 4, 4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded text."""
    coded = rank_bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]

#: Naive Bayes, SimHash components and BPE are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
