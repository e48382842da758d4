"""Offline replay: stored raw files to a table through the same extraction and gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.extract_approaches import judge_approaches, settled_payloads
from perigee.operators.extract_catalog import batch_tally
from perigee.plans.quality import approach_gate, catalog_gate
from perigee.runtime import materialize
from perigee.schemas import table_columns
from perigee.sources.raw import approach_entries, payload_files

SOURCE = ["source_file", "source_sha256"]


def replay_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the raw documents that pass the gate, stamped with file name and digest; and the gate itself.

    The documents are parsed, judged and counted once, into a written table that both are made of without another
    shuffle. Every document has a row in the gate, also one that can't be read or holds no record.
    """
    settled = materialize(settled_payloads(judge_approaches(approach_entries(payloads), SOURCE), SOURCE), "judged")
    gate = approach_gate(settled.filter("nth = 1").drop("nth", "kept"))
    rows = approach_gate(settled).filter(F.col("gate_passed") & F.col("kept").isNotNull())
    named = rows.select(
        *[F.col("kept")[c].alias(c) for c in table_columns("asteroids")],
        F.element_at(F.split("source_file", "/"), -1).alias("source_raw_file"),
        F.col("source_sha256").alias("source_raw_sha256"))
    return named, gate


def approach_summary(gate: DataFrame, run_id: str, start_date: str, end_date: str) -> DataFrame:
    """The one-row summary of a run from the gate of its payloads: their counts, and the gate over all of them."""
    totals = gate.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records_received", "valid_records", "skipped_records")])
    judged = approach_gate(totals)
    return judged.select(
        F.lit(run_id).alias("run_id"), F.lit(start_date).alias("start_date"), F.lit(end_date).alias("end_date"), "records_received",
        "valid_records", "skipped_records", "rejection_pct", "gate_passed")


def catalog_summary(classified: DataFrame) -> DataFrame:
    """The summary of each catalog run (snapshot_key, run_id, snapshot_time) from its classified targets."""
    return catalog_gate(batch_tally(classified, ["snapshot_key", "run_id", "snapshot_time"]))


def replay_approaches(spark: SparkSession, raw_path: str) -> tuple[DataFrame, DataFrame]:
    return replay_payloads(payload_files(spark, raw_path))
