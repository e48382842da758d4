"""The registered queries: name -> (callable, SQL check or None, blueprint ids)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        REGISTRY[name] = Query(run, sql, covers)
        return run

    return add


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as comma-separated text, for comparison."""
    return df.withColumns({c: F.array_join(c, ",") for c in columns})


def metrics_as_text(checks: DataFrame) -> DataFrame:
    """Check rows with their metrics as `name=value` text."""
    pairs = F.transform(F.map_entries("metrics"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return checks.select("check_name", "dataset", "status", F.array_join(pairs, ";").alias("metrics"))


def load() -> dict[str, Query]:
    """All queries; the modules register on import."""
    from perigee.bindings import feed_queries, gate_queries, history_queries, identity_queries, publication_queries, scalar_queries  # noqa: F401

    return REGISTRY
