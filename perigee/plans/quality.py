"""Quality gates. Every check is one row (check_name, dataset, status, diagnostic, metrics).

A check reads its tables through aggregates; only the folder listings, a few names each, are taken
on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.operators.tallying import orphans
from perigee.runtime import one_row
from perigee.schemas import CATALOG_TABLES, CHECK_DDL
from perigee.sources.files import exists, first_existing, listing
from perigee.sources.publication import publication_gaps
from perigee.sources.raw import read_summary
from perigee.sources.tables import ALIASES, read_table, stored_columns

REJECTION_LIMIT_PCT = 20.0
FAILURE_LIMIT_PCT = 25.0
ARITHMETIC_TOLERANCE = 0.05

APPROACH_SUMMARY = "neows_summary.json"
APPROACH_TABLE = "asteroids.parquet"
CATALOG_SUMMARY = "sbdb_batch_summary.json"

APPROACH_SUMMARY_DDL = (
    "run_id string, start_date string, end_date string, records_received bigint, valid_records bigint, "
    "skipped_records bigint, rejection_pct double, gate_passed boolean"
)
CATALOG_SUMMARY_DDL = (
    "run_id string, snapshot_key string, snapshot_time string, total_targets bigint, "
    "successful_targets_count bigint, failed_targets_count bigint, duplicate_targets_count bigint, "
    "failure_rate_pct double, circuit_breaker_passed boolean"
)


# --- building check rows -------------------------------------------------------------------------

def verdict(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), V.PASSED).otherwise(V.FAILED)


def check_row(df: DataFrame, name: str, dataset: str, status: Column, diagnostic: Column,
              metrics: dict[str, Column] | None = None) -> DataFrame:
    entries = [x for k, v in (metrics or {}).items() for x in (F.lit(k), v.cast("string"))]
    packed = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return df.select(
        F.lit(name).alias("check_name"), F.lit(dataset).alias("dataset"), status.alias("status"),
        diagnostic.alias("diagnostic"), packed.alias("metrics"))


def fixed_check(spark: SparkSession, name: str, dataset: str, status: str, diagnostic: str,
                metrics: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame([(name, dataset, status, diagnostic, metrics or {})], CHECK_DDL)


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def share_pct(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(empty))


# --- gates over an extraction in flight ----------------------------------------------------------

def approach_gate(tally: DataFrame) -> DataFrame:
    """Rejection rate and gate of each payload: some valid rows, strictly under 20 % rejected."""
    pct = share_pct(F.col("skipped_records"), F.col("records_received"))
    return tally.withColumn("rejection_pct", F.round(pct, 2)).withColumn(
        "gate_passed", (F.col("valid_records") > 0) & (pct < REJECTION_LIMIT_PCT))


def risk_gate(tally: DataFrame) -> DataFrame:
    """No valid row halts; more than 20 % rejected only warns."""
    pct = share_pct(F.col("skipped_records"), F.col("records_received"))
    status = (
        F.when(F.col("valid_records") == 0, V.FAILED).when(pct > REJECTION_LIMIT_PCT, V.WARNING).otherwise(V.PASSED)
    )
    return tally.withColumn("rejection_pct", F.round(pct, 2)).withColumn("status", status)


def catalog_gate(tally: DataFrame) -> DataFrame:
    """The circuit breaker of each batch: some success, strictly under 25 % failed."""
    pct = share_pct(F.col("failed_targets_count"), F.col("total_targets"), empty=100.0)
    return tally.withColumn("failure_rate_pct", F.round(pct, 2)).withColumn(
        "circuit_breaker_passed", (F.col("successful_targets_count") > 0) & (pct < FAILURE_LIMIT_PCT))


def passing(rows: DataFrame, gate: DataFrame, scope: list[str], flag: str = "gate_passed") -> DataFrame:
    """Rows of payloads that passed their gate; the others are withheld whole."""
    return rows.join(gate.filter(F.col(flag)).select(*scope), scope, "left_semi")


# --- stored summaries against stored tables ------------------------------------------------------

def approach_summary_check(summary: DataFrame) -> DataFrame:
    received, valid = F.coalesce("records_received", F.lit(0)), F.coalesce("valid_records", F.lit(0))
    skipped, pct = F.coalesce("skipped_records", F.lit(0)), F.coalesce("rejection_pct", F.lit(100.0))
    math_ok = F.abs(pct - F.round(share_pct(skipped, received), 2)) <= ARITHMETIC_TOLERANCE
    gate = F.coalesce("gate_passed", F.lit(False))
    ok = gate & (valid > 0) & (pct < REJECTION_LIMIT_PCT) & math_ok
    return check_row(
        summary, "neows_gate_validation", "neows", verdict(ok),
        F.format_string("gate=%s valid=%d skipped=%d rejection=%.1f%% arithmetic=%s", gate, valid, skipped, pct, math_ok),
        {"records_received": received, "valid_records": valid, "skipped_records": skipped, "rejection_pct": pct,
         "gate_passed": gate, "math_valid": math_ok})


def approach_lineage_check(summary: DataFrame, table: DataFrame | None, runs: DataFrame | None = None) -> DataFrame:
    """Row count against the summary; run ids when both sides have one; suppression after a failed gate."""
    gate = F.coalesce("gate_passed", F.lit(False))
    if table is None:
        return check_row(
            summary, "neows_parquet_lineage", "neows", F.when(gate, V.FAILED).otherwise(V.NOT_APPLICABLE),
            F.when(gate, "table missing after a passed gate").otherwise("table suppressed after a failed gate"),
            {"expected_valid_records": F.coalesce("valid_records", F.lit(0))})
    counted = one_row(table.agg(F.count(F.lit(1)).alias("table_rows")))
    stamped = runs.agg(F.max("run_id").alias("table_run")) if runs is not None else counted.select(
        F.lit(None).cast("string").alias("table_run"))
    row = summary.crossJoin(counted).crossJoin(one_row(stamped))
    same_rows = F.col("table_rows") == F.coalesce("valid_records", F.lit(0))
    same_run = F.coalesce(F.col("table_run") == F.nullif(F.col("run_id"), F.lit("")), F.lit(True))
    status = F.when(~gate, V.FAILED).otherwise(verdict(same_rows & same_run))
    return check_row(
        row, "neows_parquet_lineage", "neows", status,
        F.when(~gate, "table present despite a failed gate").otherwise(
            F.format_string("rows=%d expected=%d run match=%s", "table_rows", F.coalesce("valid_records", F.lit(0)), same_run)),
        {"parquet_rows": F.col("table_rows"), "summary_valid_records": F.col("valid_records"),
         "embedded_run_id": F.col("table_run"), "summary_run_id": F.col("run_id")})


def risk_snapshot_check(risk: DataFrame) -> DataFrame:
    """One snapshot: not empty, one row per non-empty id, probabilities in [0, 1]."""
    p = F.col("impact_probability")
    # Per id first, so distinct ids are a plain count of groups.
    per_id = risk.groupBy(F.when(F.col("sentry_id") != "", F.col("sentry_id")).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((p < 0) | (p > 1)).alias("bad"))
    row = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("k").alias("ids"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    rows, ids, bad = F.col("rows"), F.col("ids"), F.col("bad")
    return check_row(
        row, "sentry_snapshot_validation", "sentry", verdict((rows > 0) & (ids == rows) & (bad == 0)),
        F.format_string("rows=%d ids=%d probabilities out of range=%d", rows, ids, bad),
        {"row_count": rows, "unique_sentry_ids": ids, "grain_unique": ids == rows, "bounds_valid": bad == 0})


def catalog_summary_check(summary: DataFrame) -> DataFrame:
    zero = F.lit(0)
    total, good = F.coalesce("total_targets", zero), F.coalesce("successful_targets_count", zero)
    bad, twice = F.coalesce("failed_targets_count", zero), F.coalesce("duplicate_targets_count", zero)
    pct, breaker = F.coalesce("failure_rate_pct", F.lit(100.0)), F.coalesce("circuit_breaker_passed", F.lit(False))
    math_ok = F.abs(pct - F.round(share_pct(bad, total, empty=100.0), 2)) <= ARITHMETIC_TOLERANCE
    ok = breaker & (good > 0) & (pct < FAILURE_LIMIT_PCT) & math_ok & (good + bad + twice == total)
    return check_row(
        summary, "sbdb_circuit_breaker", "sbdb", verdict(ok),
        F.format_string("breaker=%s successful=%d/%d failure=%.1f%% arithmetic=%s", breaker, good, total, pct, math_ok),
        {"total_targets": total, "successful_targets_count": good, "failed_targets_count": bad,
         "duplicate_targets_count": twice, "failure_rate_pct": pct, "circuit_breaker_passed": breaker,
         "math_valid": math_ok})


def catalog_lineage_check(summary: DataFrame, objects: DataFrame | None, any_table: bool) -> DataFrame:
    breaker = F.coalesce("circuit_breaker_passed", F.lit(False))
    expected = F.coalesce("successful_targets_count", F.lit(0))
    if objects is None:
        row = summary.withColumn("object_rows", F.lit(None).cast("bigint"))
    else:
        row = summary.crossJoin(one_row(objects.agg(F.count(F.lit(1)).alias("object_rows"))))
    tripped = F.lit(V.FAILED if any_table else V.NOT_APPLICABLE)
    status = F.when(~breaker, tripped).otherwise(verdict(F.col("object_rows") == expected))
    return check_row(
        row, "sbdb_ingestion_lineage", "sbdb", status,
        F.when(~breaker, "tables present despite a tripped breaker" if any_table else "tables suppressed after a trip")
        .otherwise(F.concat(F.lit("object rows "), F.coalesce(F.col("object_rows").cast("string"), F.lit("missing")),
                            F.lit(", expected "), expected.cast("string"))),
        {"object_rows": F.col("object_rows"), "summary_successful_targets": expected})


# --- structure and dates -------------------------------------------------------------------------

def _repeated(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """One row: how many key groups hold more than one row."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return one_row(groups.agg(F.count_if(F.col("n") > 1).alias(out)))


def _orphan_count(children: DataFrame, parents: DataFrame, key: str, out: str) -> DataFrame:
    # Children are reduced to distinct keys before the anti join.
    wanted = children.select(key).filter(F.col(key) != "").distinct()
    return one_row(orphans(wanted, parents.select(key), key).agg(F.count(F.lit(1)).alias(out)))


def structure_check(objects: DataFrame, orbits: DataFrame, elements: DataFrame, physical: DataFrame) -> DataFrame:
    """Object and orbit are unique per (snapshot, spkid), and every child's spkid has an object."""
    grain = ["snapshot_key", "spkid"]
    row = one_row(objects.agg(F.count(F.lit(1)).alias("objects")))
    row = row.crossJoin(_repeated(objects, grain, "object_dups")).crossJoin(_repeated(orbits, grain, "orbit_dups"))
    children = orbits.select("spkid").unionByName(elements.select("spkid")).unionByName(physical.select("spkid"))
    row = row.crossJoin(_orphan_count(children, objects, "spkid", "orphan_ids"))
    unique = (F.col("object_dups") == 0) & (F.col("orbit_dups") == 0)
    whole = F.col("orphan_ids") == 0
    return check_row(
        row, "sbdb_structural_integrity", "sbdb", verdict(unique & whole),
        F.format_string("objects=%d repeated object keys=%d repeated orbit keys=%d orphan ids=%d",
                        "objects", "object_dups", "orbit_dups", "orphan_ids"),
        {"grain_unique": unique, "referential_integrity": whole})


def window_violations(approaches: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row: approaches dated outside [start, end] and the first five distinct offending dates.

    Offenders are grouped by date, so the list is built from at most one row per calendar day.
    """
    date = F.col("closest_approach_date")
    outside = approaches.filter((date < start) | (date > end) | date.isNull())
    per_date = outside.groupBy("closest_approach_date").agg(F.count(F.lit(1)).alias("n"))
    top = per_date.orderBy(F.asc_nulls_last("closest_approach_date")).limit(5)
    sample = top.agg(F.array_join(F.array_sort(F.collect_list("closest_approach_date")), ",").alias("first_dates"))
    return per_date.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("outside")).crossJoin(one_row(sample))


def snapshot_mismatches(snapshots: DataFrame, expected: Column, out: str) -> DataFrame:
    """One row: rows whose key, or the date of whose time, is not the expected day."""
    dated = F.when(F.length("snapshot_time") >= 10, F.substring("snapshot_time", 1, 10))
    wrong = ~F.col("snapshot_key").eqNullSafe(expected) | F.coalesce(dated != expected, F.lit(False))
    return one_row(snapshots.agg(F.count_if(wrong).alias(out)))


def partition_dates_check(
    spark: SparkSession, approaches: DataFrame | None = None, start: str | None = None, end: str | None = None,
    risk: DataFrame | None = None, risk_date: str | None = None, objects: DataFrame | None = None,
    object_date: str | None = None,
) -> DataFrame:
    """Approach dates inside the window; risk and object snapshots on their day. Parts without data pass."""
    row = spark.range(1).select(F.lit(0).cast("bigint").alias("base"))
    wrong, notes = F.lit(0).cast("bigint"), []
    if approaches is not None and start and end:
        row = row.crossJoin(one_row(window_violations(approaches, F.lit(start), F.lit(end))))
        wrong = wrong + F.col("outside")
        notes.append(F.when(F.col("outside") > 0, F.concat(
            F.lit(f"approach dates outside [{start}, {end}]: "), F.col("first_dates"))))
    if risk is not None:
        # Without a given date the whole table must agree on one day.
        expected = F.lit(risk_date) if risk_date else F.col("risk_day")
        source = risk if risk_date else risk.crossJoin(one_row(risk.agg(F.min("snapshot_key").alias("risk_day"))))
        row = row.crossJoin(snapshot_mismatches(source, expected, "risk_wrong"))
        wrong = wrong + F.col("risk_wrong")
        notes.append(F.when(F.col("risk_wrong") > 0, F.lit("risk snapshot off its date")))
    if objects is not None and object_date:
        row = row.crossJoin(snapshot_mismatches(objects, F.lit(object_date), "object_wrong"))
        wrong = wrong + F.col("object_wrong")
        notes.append(F.when(F.col("object_wrong") > 0, F.lit("catalog snapshot off its date")))
    note = F.concat_ws("; ", *notes) if notes else F.lit("")
    return check_row(
        row, "source_partition_dates", "pipeline_outputs", verdict(wrong == 0),
        F.when(wrong == 0, "dates verified").otherwise(note), {"partition_dates_valid": wrong == 0})


# --- crosswalk -----------------------------------------------------------------------------------

def bridge_check(bridge: DataFrame) -> DataFrame:
    """Not empty, exactly one primary pivot per entity, and no identifier listed twice."""
    per_key = bridge.groupBy("asteroid_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_primary_pivot").alias("pivots"))
    keys = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("pivots") != 1).alias("bad_keys"))
    row = keys.crossJoin(_repeated(bridge, ["source_system", "identifier_name", "identifier_value"], "repeated"))
    unique = F.col("repeated") == 0
    ok = (F.col("rows") > 0) & (F.col("bad_keys") == 0) & unique
    return check_row(
        row, "crosswalk_bridge_invariants", "crosswalk", verdict(ok),
        F.format_string("rows=%d keys=%d keys without one pivot=%d repeated identifiers=%d", "rows", "keys", "bad_keys", "repeated"),
        {"bridge_rows": F.col("rows"), "distinct_asteroid_keys": F.col("keys"),
         "keys_with_invalid_pivots": F.col("bad_keys"), "identifier_tuples_unique": unique})


def audit_check(audit: DataFrame, bridge: DataFrame) -> DataFrame:
    """One run, nothing ambiguous, and every assigned key present in the bridge."""
    per_run = audit.groupBy(F.nullif(F.col("resolution_run_id"), F.lit("")).alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.upper("match_state") == V.AMBIGUOUS).alias("ambiguous"))
    runs = per_run.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("run").alias("runs"),
        F.coalesce(F.sum("ambiguous"), F.lit(0)).alias("ambiguous"))
    assigned = audit.filter(F.col("assigned_asteroid_key") != "").groupBy(
        F.col("assigned_asteroid_key").alias("asteroid_key")).agg(F.count(F.lit(1)).alias("n"))
    lost = orphans(assigned, bridge, "asteroid_key").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
    row = runs.crossJoin(one_row(lost))
    ok = (F.col("runs") == 1) & (F.col("ambiguous") == 0) & (F.col("orphans") == 0)
    return check_row(
        row, "crosswalk_audit_invariants", "crosswalk", verdict(ok),
        F.format_string("rows=%d runs=%d ambiguous=%d assigned keys without bridge=%d", "rows", "runs", "ambiguous", "orphans"),
        {"audit_rows": F.col("rows"), "run_count": F.col("runs"), "ambiguous_records_count": F.col("ambiguous"),
         "orphan_assigned_keys": F.col("orphans")})


# --- folders -------------------------------------------------------------------------------------

def artifact_check(spark: SparkSession, folder: str, mode: str = V.PRODUCTION) -> DataFrame:
    """The expected datasets are present and hold bytes; the four catalog tables come all or none."""
    names = [APPROACH_SUMMARY, APPROACH_TABLE, CATALOG_SUMMARY, *[f"{t}.parquet" for t in CATALOG_TABLES]]
    if mode != V.BACKFILL:
        risk = first_existing(spark, folder, ALIASES["fact_sentry_risk_snapshot"])
        names.append(risk.rsplit("/", 1)[1] if risk else ALIASES["fact_sentry_risk_snapshot"][0])
    catalog = F.col("name").isin([f"{t}.parquet" for t in CATALOG_TABLES]) & F.col("present")
    row = listing(spark, folder, names).agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(F.col("present") & (F.col("bytes") > 0)).alias("found"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("present"), F.col("name")))), ",").alias("missing"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("present") & (F.col("bytes") == 0), F.col("name")))), ",").alias("empty"),
        F.count_if(catalog).alias("catalog_tables"))
    split = F.col("catalog_tables").between(1, 3)
    return check_row(
        row, "pre_resolution_output_accounting", "pipeline_outputs", verdict((F.col("found") == F.col("expected")) & ~split),
        F.format_string("%d/%d present; missing: %s; empty: %s", "found", "expected", "missing", "empty"),
        {"execution_mode": F.lit(mode), "expected_artifacts_count": F.col("expected"),
         "found_artifacts_count": F.col("found"), "missing_artifacts": F.col("missing"),
         "empty_artifacts": F.col("empty"), "orphan_sbdb_tables": split})


NAMED_KEYS = 20


def publication_check(spark: SparkSession, root: str, keys: DataFrame | None = None, verify: bool = False) -> DataFrame:
    """Every published key (column `key`) exists and is not empty; skipped unless asked for.

    The keys meet a listing of the files in a join; the check names the first lost ones and counts all,
    `publication_gaps` lists them.
    """
    name, dataset = "s3_publication_verification", "s3"
    if keys is None:
        keys = spark.createDataFrame([], "key string")
    total = keys.agg(F.countDistinct("key").alias("total"))
    if not verify:
        return check_row(total, name, dataset, F.lit(V.NOT_APPLICABLE), F.lit("publication not verified"), {"keys_count": F.col("total")})
    gaps = publication_gaps(spark, root, keys)
    first = gaps.orderBy("key").limit(NAMED_KEYS).agg(F.array_join(F.sort_array(F.collect_list("key")), ",").alias("lost"))
    row = total.crossJoin(one_row(gaps.agg(F.count(F.lit(1)).alias("lost_keys")))).crossJoin(one_row(first))
    verified = F.col("total") - F.col("lost_keys")
    return check_row(
        row, name, dataset, verdict(F.col("lost_keys") == 0),
        F.format_string("%d/%d verified; missing or empty: %s", verified, "total", "lost"),
        {"total_keys": F.col("total"), "verified_count": verified, "lost_keys": F.col("lost")})


def roll_up(checks: DataFrame) -> DataFrame:
    """One row: counts per status and the overall status (failed, else warning, else passed)."""
    of = lambda s: F.count_if(F.col("status") == s)
    counted = checks.agg(
        F.count(F.lit(1)).alias("total_checks"), of(V.PASSED).alias("passed"), of(V.FAILED).alias("failed"),
        of(V.WARNING).alias("warnings"), of(V.BLOCKED).alias("blocked"), of(V.NOT_APPLICABLE).alias("not_applicable"))
    overall = F.when(F.col("failed") > 0, V.FAILED).when(F.col("warnings") > 0, V.WARNING).otherwise(V.PASSED)
    return counted.select(overall.alias("overall_status"), "*")


def _approach_ingestion(spark: SparkSession, folder: str) -> list[DataFrame]:
    summary = read_summary(spark, f"{folder}/{APPROACH_SUMMARY}", APPROACH_SUMMARY_DDL)
    if not summary.filter("readable").head(1):
        return [fixed_check(spark, n, "neows", s, "approach summary missing or unreadable") for n, s in (
            ("neows_summary_presence", V.FAILED), ("neows_gate_validation", V.BLOCKED), ("neows_parquet_lineage", V.BLOCKED))]
    path = f"{folder}/{APPROACH_TABLE}"
    table = read_table(spark, path, "asteroids") if exists(spark, path) else None
    runs = spark.read.parquet(f"{path}_runs") if exists(spark, f"{path}_runs") else None
    return [approach_summary_check(summary), approach_lineage_check(summary, table, runs)]


def _catalog_ingestion(spark: SparkSession, folder: str) -> list[DataFrame]:
    summary = read_summary(spark, f"{folder}/{CATALOG_SUMMARY}", CATALOG_SUMMARY_DDL)
    if not summary.filter("readable").head(1):
        return [fixed_check(spark, n, "sbdb", s, "catalog summary missing or unreadable") for n, s in (
            ("sbdb_summary_presence", V.FAILED), ("sbdb_circuit_breaker", V.BLOCKED), ("sbdb_ingestion_lineage", V.BLOCKED))]
    paths = {t: f"{folder}/{t}.parquet" for t in CATALOG_TABLES}
    there = {t: exists(spark, p) for t, p in paths.items()}
    objects = read_table(spark, paths[CATALOG_TABLES[0]], CATALOG_TABLES[0]) if there[CATALOG_TABLES[0]] else None
    return [catalog_summary_check(summary), catalog_lineage_check(summary, objects, any(there.values()))]


def _risk_ingestion(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    name, dataset = "sentry_snapshot_validation", "sentry"
    if mode == V.BACKFILL:
        return fixed_check(spark, name, dataset, V.NOT_APPLICABLE, "risk snapshot left out of a backfill")
    path = first_existing(spark, folder, ALIASES["fact_sentry_risk_snapshot"])
    if path is None:
        return fixed_check(spark, name, dataset, V.FAILED, "risk snapshot missing")
    return risk_snapshot_check(read_table(spark, path, "fact_sentry_risk_snapshot"))


def output_checks(spark: SparkSession, folder: str, mode: str = V.PRODUCTION, snapshot_date: str | None = None,
                  start_date: str | None = None, end_date: str | None = None) -> list[DataFrame]:
    """Accounting, catalog structure and dates of an output folder."""
    checks = [artifact_check(spark, folder, mode)]
    paths = {t: f"{folder}/{t}.parquet" for t in CATALOG_TABLES}
    if all(exists(spark, p) for p in paths.values()):
        checks.append(structure_check(*[read_table(spark, p, t) for t, p in paths.items()]))
    else:
        checks.append(fixed_check(spark, "sbdb_structural_integrity", "sbdb", V.BLOCKED, "catalog tables incomplete"))
    # The window and the catalog day come from the summaries unless they are given: one row each.
    approach_run = read_summary(spark, f"{folder}/{APPROACH_SUMMARY}", APPROACH_SUMMARY_DDL).head(1)
    catalog_run = read_summary(spark, f"{folder}/{CATALOG_SUMMARY}", CATALOG_SUMMARY_DDL).head(1)
    start = start_date or (approach_run[0]["start_date"] if approach_run else None)
    end = end_date or (approach_run[0]["end_date"] if approach_run else None)
    day = snapshot_date or (catalog_run[0]["snapshot_key"] if catalog_run else None)
    path = f"{folder}/{APPROACH_TABLE}"
    dated = exists(spark, path) and "closest_approach_date" in stored_columns(spark, path)
    risk = None if mode == V.BACKFILL else first_existing(spark, folder, ALIASES["fact_sentry_risk_snapshot"])
    obj = paths[CATALOG_TABLES[0]]
    checks.append(partition_dates_check(
        spark, read_table(spark, path, "asteroids") if dated else None, start, end,
        read_table(spark, risk, "fact_sentry_risk_snapshot") if risk else None, snapshot_date,
        read_table(spark, obj, CATALOG_TABLES[0]) if exists(spark, obj) else None, day))
    return checks


def crosswalk_checks(spark: SparkSession, folder: str) -> list[DataFrame]:
    bridge_path = first_existing(spark, folder, ALIASES["bridge_asteroid_identifier"])
    if bridge_path is None:
        return [fixed_check(spark, "crosswalk_bridge_invariants", "crosswalk", V.NOT_APPLICABLE, "crosswalk not built yet")]
    bridge = read_table(spark, bridge_path, "bridge_asteroid_identifier")
    audit_path = first_existing(spark, folder, ALIASES["fact_entity_resolution"])
    if audit_path is None:
        return [bridge_check(bridge), fixed_check(
            spark, "crosswalk_audit_invariants", "crosswalk", V.WARNING, "audit table not found; not checked")]
    return [bridge_check(bridge), audit_check(read_table(spark, audit_path, "fact_entity_resolution"), bridge)]


def full_suite(spark: SparkSession, folder: str, mode: str = V.PRODUCTION, snapshot_date: str | None = None,
               start_date: str | None = None, end_date: str | None = None, publish_root: str | None = None,
               publish_keys: DataFrame | None = None, verify: bool = False) -> DataFrame:
    """All gates of an output folder, as check rows; `publish_keys` is a table with a column `key`."""
    return union_checks([
        *_approach_ingestion(spark, folder), _risk_ingestion(spark, folder, mode), *_catalog_ingestion(spark, folder),
        *output_checks(spark, folder, mode, snapshot_date, start_date, end_date), *crosswalk_checks(spark, folder),
        publication_check(spark, publish_root or folder, publish_keys, verify)])
