"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, BPE encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from perigee.llm import bpe, decontaminate, line_spread, quality, simhash
from perigee.llm.common import documents
from perigee.runtime import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Names of what the operators compute; a column of documents so named gives way at every stage.
COMPUTED = ("kept", "simhash", "leaks", "ids")


def carried(docs: DataFrame) -> DataFrame:
    """`docs` with all their columns but those of `COMPUTED`."""
    return docs.drop(*COMPUTED)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and have enough content lines."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.retained(carried(docs), quality.fit(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on many sites in as many texts; what is only copied stays for the next stage."""
    docs = carried(docs)
    # The operator adds columns of these names; the documents' own step aside meanwhile.
    own = {c: f"__own_{c}" for c in docs.columns if c.lower() in line_spread.ADDED}
    found = line_spread.without_boilerplate(docs.withColumnsRenamed(own), min_texts=line_spread.MIN_SITES).drop(*line_spread.ADDED)
    return found.withColumnsRenamed({v: k for k, v in own.items()})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return simhash.one_of_each(carried(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_leaks(carried(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids of their text."""
    return bpe.encoded(carried(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# A random field and a Hamming search aren't SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is a written table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
