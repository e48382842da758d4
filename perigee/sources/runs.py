"""The audit log of all resolution runs: one folder per run, and a table of runs beside it.

Which run is the newest is read from the table of runs, a row each; the log is then read from that run's
folder alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.schemas import table_columns, table_schema
from perigee.sources.files import exists
from perigee.sources.tables import check_contract, empty_table

AUDIT = "fact_entity_resolution"
RUNS_DDL = "resolution_run_id string, resolved_at string, evaluations bigint"


def append_run(audit: DataFrame, root: str) -> None:
    """Add the audit rows of a run to the log, then the run to the table of runs, so that a run is known
    only when it is whole."""
    rows = check_contract(audit, AUDIT)
    rows.hint("rebalance", "resolution_run_id").write.mode("append").partitionBy("resolution_run_id").parquet(f"{root}/log")
    known = rows.groupBy("resolution_run_id").agg(F.max("resolved_at").alias("resolved_at"), F.count(F.lit(1)).alias("evaluations"))
    known.write.mode("append").parquet(f"{root}/runs")


def runs(spark: SparkSession, root: str) -> DataFrame:
    """(resolution_run_id, resolved_at, evaluations) of the runs in the log."""
    if not exists(spark, f"{root}/runs"):
        return spark.createDataFrame([], RUNS_DDL)
    return spark.read.schema(RUNS_DDL).parquet(f"{root}/runs")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of all runs that are known."""
    if not exists(spark, f"{root}/log"):
        return empty_table(spark, AUDIT)
    log = spark.read.schema(table_schema(AUDIT)).option("basePath", f"{root}/log").parquet(f"{root}/log")
    return log.join(runs(spark, root).select("resolution_run_id"), "resolution_run_id", "left_semi").select(*table_columns(AUDIT))


def read_latest_run(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of the newest run, by clock and then by id, from that run's folder alone.

    The newest run is one row of the table of runs, taken to the driver, so the read is pruned when it is planned.
    """
    newest = runs(spark, root).agg(F.max(F.struct("resolved_at", "resolution_run_id")).alias("r")).first()
    rows = read_runs(spark, root)
    return rows.filter(F.col("resolution_run_id") == newest.r.resolution_run_id) if newest.r else rows.limit(0)
