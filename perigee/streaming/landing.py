"""Incremental ingest: new raw files in, unseen table rows out.

The same extractors run on every micro-batch. A batch that is repeated after a failure adds nothing,
because rows whose grain is already stored are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.operators import extract_approaches as approaches
from perigee.operators import extract_risk as risk
from perigee.operators.extract_approaches import PLACE, accepted_rows, judge_approaches
from perigee.operators.extract_risk import accepted_risk_rows, judge_risk
from perigee.operators.picking import insert_if_absent
from perigee.plans.quality import approach_gate, passing, risk_gate
from perigee.runtime import materialize
from perigee.schemas import table_columns
from perigee.sources.files import exists
from perigee.sources.raw import approach_entries, risk_entries
from perigee.sources.tables import check_contract, read_table

RAW_FILE_DDL = "path string, modificationTime timestamp, length bigint, content binary"


def raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New whole files of a landing folder with the digest of their bytes."""
    files = spark.readStream.format("binaryFile").schema(RAW_FILE_DDL).load(folder)
    return files.select(
        F.col("path").alias("source_file"), F.decode("content", "UTF-8").alias("payload"),
        F.sha2(F.col("content"), 256).alias("source_sha256"))


def append_unseen(rows: DataFrame, name: str, path: str, grain: list[str], order: list[str], between: str) -> None:
    spark = rows.sparkSession
    own = check_contract(rows.drop(*order), name).columns
    fresh = insert_if_absent(read_table(spark, path, name), rows.select(*own, *order), grain, order, between)
    materialize(fresh.select(*own), f"batch-{name}").write.mode("append").parquet(path)


def quarantine(refused: DataFrame, path: str) -> None:
    """Refused files with their figures, beside the table; a file that is listed already stays as it is."""
    spark, place = refused.sparkSession, f"{path}_quarantine"
    if exists(spark, place):
        refused = refused.join(spark.read.parquet(place).select("source_file"), "source_file", "left_anti")
    materialize(refused, "refused").write.mode("append").parquet(place)


def ingest_approaches(spark: SparkSession, folder: str, table_path: str, checkpoint: str):
    """Run once over everything new in the folder, then stop. A file that fails the gate loads nothing
    and is listed in `<table_path>_quarantine`."""
    scope = ["source_file"]

    def handle(batch: DataFrame, _: int) -> None:
        # Parsed once: rows, gate and quarantine are made of the judged records.
        judged = materialize(judge_approaches(approach_entries(batch.drop("source_sha256")), scope), "judged")
        gate = materialize(approach_gate(approaches.payload_tally(judged, scope)), "gate")
        quarantine(gate.filter(~F.col("gate_passed")), table_path)
        rows = passing(accepted_rows(judged, scope, placed=True), gate, scope)
        append_unseen(rows, "asteroids", table_path, ["id", "closest_approach_date"], [*scope, *PLACE], "closest_approach_date")

    return (raw_stream(spark, folder).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_risk(spark: SparkSession, folder: str, table_path: str, checkpoint: str):
    """Risk files named `<snapshot_key>_<run_id>.json`; the snapshot comes from the name. A file without
    a valid row loads nothing and is listed in `<table_path>_quarantine`."""
    scope = ["snapshot_key", "run_id", "snapshot_time"]

    def handle(batch: DataFrame, _: int) -> None:
        stem = F.regexp_extract("source_file", r"([^/]+)\.json$", 1)
        files = batch.withColumns({
            "snapshot_key": F.substring(stem, 1, 10), "run_id": F.substring(stem, F.lit(12), F.length(stem)),
            "snapshot_time": F.concat(F.substring(stem, 1, 10), F.lit("T00:00:00Z"))})
        judged = materialize(judge_risk(risk_entries(files.drop("source_sha256")), [*scope, "source_file"]), "judged")
        gate = risk_gate(risk.payload_tally(judged, [*scope, "source_file"]))
        quarantine(gate.filter(F.col("status") == V.FAILED), table_path)
        rows = accepted_risk_rows(judged, scope).select(*table_columns("fact_sentry_risk_snapshot"))
        append_unseen(rows, "fact_sentry_risk_snapshot", table_path, ["snapshot_key", "sentry_id"], [], "snapshot_key")

    return (raw_stream(spark, folder).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
