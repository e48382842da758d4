"""The list of catalog targets to fetch: where it comes from, cleaned, distinct and sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.functions.text import squeeze, strip, unwrap

# Used when nothing else is given.
DEFAULT_TARGET = "2025 HX"


def clean_targets(raw: DataFrame, column: str = "target") -> DataFrame:
    cleaned = strip(unwrap(squeeze(F.col(column))))
    return raw.select(cleaned.alias("target")).filter("target <> ''").distinct().orderBy("target")


def resolve_targets(
    spark: SparkSession, targets_file: str | None = None, targets: str | list[str] | DataFrame | None = None,
    target: str | None = None,
) -> DataFrame:
    """File, then list, then single target, then the default. `#` starts a comment line in a file."""
    if targets_file:
        lines = spark.read.text(targets_file).select(strip(F.col("value")).alias("target"))
        raw = lines.filter((F.col("target") != "") & ~F.col("target").startswith("#"))
    elif isinstance(targets, DataFrame):
        raw = targets
    elif targets:
        parts = targets.split(",") if isinstance(targets, str) else list(targets)
        raw = spark.createDataFrame([(str(p),) for p in parts], "target string")
    else:
        raw = spark.createDataFrame([((target or "").strip() or DEFAULT_TARGET,)], "target string")
    return clean_targets(raw)
