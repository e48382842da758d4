"""The registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm import alignment, bpe, decontaminate, language, line_spread, prefix_counts, prefix_trie, quality, secrets, shards, simhash, token_files, toxicity
from perigee.llm.common import documents

Run = Callable[[SparkSession, str], DataFrame]

# A stored row is told apart by its file and its position there.
STORED_ROW = ("_metadata.file_path", "_metadata.row_index")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.report(documents(spark, sf_dir), [F.col(c) for c in STORED_ROW])


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), [F.col(c) for c in STORED_ROW])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(documents(spark, sf_dir))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(documents(spark, sf_dir).select("doc_id", "text"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.report(documents(spark, sf_dir).select("doc_id", "source", "text"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.report(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Run] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_bpe": op2_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_token_files": op5_token_files,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op7_decontamination": decontaminate.REPORT_SQL, "op10_line_dedup": line_spread.REPORT_SQL, "op13_prefix_trie": prefix_trie.REPORT_SQL,
}
