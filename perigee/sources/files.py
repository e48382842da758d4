"""Path tests and listings through the Hadoop file system of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LISTING_DDL = "name string, path string, present boolean, bytes bigint"


def _handle(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _handle(spark, path)
    return fs.exists(hadoop)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a file or folder; 0 when it is missing."""
    fs, hadoop = _handle(spark, path)
    return fs.getContentSummary(hadoop).getLength() if fs.exists(hadoop) else 0


def first_existing(spark: SparkSession, folder: str, candidates: list[str]) -> str | None:
    """Path of the first candidate name present in the folder."""
    for name in candidates:
        path = name if name.startswith("/") or "://" in name else f"{folder}/{name}"
        if exists(spark, path):
            return path
    return None


def listing(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(name, path, present, bytes) of a fixed list of names."""
    rows = [(n, f"{folder}/{n}", exists(spark, f"{folder}/{n}"), total_bytes(spark, f"{folder}/{n}")) for n in names]
    return spark.createDataFrame(rows, LISTING_DDL)
