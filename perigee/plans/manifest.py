"""Run manifests: stages of a run rolled up to one row per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions.dates import run_document_path
from perigee.functions.text import blank_to_null, redact_api_key, scrub_map, strip
from perigee.vocabulary import BACKFILL, PRODUCTION

SCHEMA_VERSION = "1.0.0"
# A stage has failed with one of these statuses, or with one of these flags false.
FAILED_STATUSES = ["FAILED", "FAILURE", "ERROR"]
GATE_FLAGS = ["dq_gate_passed", "failure_gate_passed", "crosswalk_gate_passed", "checks_passed"]
RISK_STAGE = "sentry"

STAGE_DDL = (
    "pipeline_run_id string, stage string, status string, dq_gate_passed boolean, failure_gate_passed boolean, "
    "crosswalk_gate_passed boolean, checks_passed boolean, published_keys array<string>, details map<string,string>"
)
RUN_DDL = (
    "pipeline_run_id string, execution_mode string, started_at string, completed_at string, duration_seconds double, "
    "overall_status string"
)


def clean_stages(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """Stages scrubbed of secrets; the risk stage of a backfill counts as absent."""
    mode = runs.select(F.col("pipeline_run_id"), F.upper(strip(F.col("execution_mode"))).alias("mode"))
    joined = stages.join(mode, "pipeline_run_id")
    dropped = (F.col("mode") == BACKFILL) & (F.col("stage") == RISK_STAGE)
    return joined.filter(~dropped).withColumn("details", scrub_map(F.col("details"))).drop("mode")


def known_runs(runs: DataFrame) -> DataFrame:
    """Runs with an id and one of the two modes."""
    return runs.filter(blank_to_null(F.col("pipeline_run_id")).isNotNull()).withColumn(
        "execution_mode", F.upper(strip(F.col("execution_mode")))).filter(F.col("execution_mode").isin(PRODUCTION, BACKFILL))


def manifest_keys(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """(pipeline_run_id, key): the distinct keys each run has published, without secrets, one per row."""
    kept = clean_stages(known_runs(runs), stages)
    published = kept.select(strip(F.col("pipeline_run_id")).alias("pipeline_run_id"), F.explode("published_keys").alias("key"))
    return published.select("pipeline_run_id", redact_api_key(strip(F.col("key"))).alias("key")).filter("key <> ''").distinct()


def _stage_failed() -> Column:
    failed = F.coalesce(F.upper(strip(F.col("status"))).isin(FAILED_STATUSES), F.lit(False))
    for flag in GATE_FLAGS:
        failed = failed | F.coalesce(~F.col(flag), F.lit(False))
    return failed


def manifest_stages(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """(pipeline_run_id, stage, status, failed, flags, details): the stages of each run, details without secrets."""
    kept = clean_stages(known_runs(runs), stages)
    return kept.select(strip(F.col("pipeline_run_id")).alias("pipeline_run_id"), "stage", F.upper(strip(F.col("status"))).alias("status"),
                       _stage_failed().alias("failed"), *GATE_FLAGS, "details")


def run_manifests(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """One row per run: status, clamped duration, number of stages, sorted distinct published keys and their number,
    document path.

    A run publishes a few keys, one per dataset and stage; `manifest_keys` has them a row each, `manifest_stages` the stages.
    """
    valid = known_runs(runs)
    kept = clean_stages(valid, stages)
    status = kept.groupBy("pipeline_run_id").agg(F.max(_stage_failed()).alias("any_failed"), F.count(F.lit(1)).alias("stage_count"))
    keys = manifest_keys(runs, stages).groupBy(F.col("pipeline_run_id").alias("keyed_run")).agg(
        F.sort_array(F.collect_list("key")).alias("published_keys"), F.count(F.lit(1)).alias("published_key_count"))
    joined = valid.join(status, "pipeline_run_id", "left").join(keys, strip(F.col("pipeline_run_id")) == F.col("keyed_run"), "left")
    began, ended = F.try_to_timestamp("started_at"), F.try_to_timestamp("completed_at")
    elapsed = (F.unix_micros(ended) - F.unix_micros(began)) / 1e6
    given = F.upper(strip(F.col("overall_status")))
    derived = F.when(F.coalesce("any_failed", F.lit(False)), "FAILED").otherwise("SUCCESS")
    return joined.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), strip(F.col("pipeline_run_id")).alias("pipeline_run_id"),
        "execution_mode", F.coalesce(given, derived).alias("overall_status"), "started_at", "completed_at",
        F.greatest(F.lit(0.0), F.round(F.coalesce("duration_seconds", elapsed, F.lit(0.0)), 2)).alias("duration_seconds"),
        F.coalesce("stage_count", F.lit(0)).alias("stage_count"),
        F.coalesce("published_keys", F.array().cast("array<string>")).alias("published_keys"),
        F.coalesce("published_key_count", F.lit(0)).alias("published_key_count"),
        run_document_path(F.col("started_at"), F.col("pipeline_run_id")).alias("manifest_path"),
    )
