"""Quality checks over the derived tables, and run manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.bindings import domain as D
from perigee.bindings import payloads as P
from perigee.bindings.feed_queries import _ORD, _TARGETS, _targets
from perigee.bindings.registry import as_text, metrics_as_text, query
from perigee.bindings.sql import with_tables
from perigee.operators import extract_risk as K
from perigee.operators.tallying import duplicated_keys, orphans
from perigee.plans import ingest, manifest, quality as Q
from perigee.runtime import fresh_path, materialize
from perigee.sources import sinks
from perigee.sources.raw import read_summary, risk_entries
from perigee.sources.tables import open_lakehouse, storage_ready


def _risk_check(rows: str) -> str:
    """The check row of a table of risk rows, as SQL."""
    return f"""SELECT 'sentry_snapshot_validation' AS check_name, 'sentry' AS dataset, CASE WHEN n > 0 AND n = k AND bad = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  'row_count=' || n || ';unique_sentry_ids=' || k || ';grain_unique=' || (n = k) || ';bounds_valid=' || (bad = 0) AS metrics
FROM (SELECT count(*) AS n, count(DISTINCT sentry_id) AS k, count(*) FILTER (impact_probability NOT BETWEEN 0 AND 1) AS bad FROM {rows})"""


_LAST_DAY = "(SELECT * FROM rsk WHERE snapshot_key = (SELECT max(snapshot_key) FROM rsk))"


@query("risk_snapshot_checks", "Q4", with_tables(
    f"{_risk_check('rsk')} UNION ALL {_risk_check(_LAST_DAY)} UNION ALL {_risk_check('(SELECT sentry_id, impact_probability * 1000 AS impact_probability FROM ' + _LAST_DAY + ')')}", "rsk"))
def _(spark, sf):
    """All days at once, the last day, and the last day with probabilities out of bounds."""
    risk = D.risk_snapshots(spark, sf)
    last = risk.join(F.broadcast(risk.agg(F.max("snapshot_key").alias("snapshot_key"))), "snapshot_key", "left_semi")
    return metrics_as_text(Q.union_checks([Q.risk_snapshot_check(r) for r in (risk, last, last.withColumn("impact_probability", F.col("impact_probability") * 1000))]))


@query("structure_checks", "Q10 J14", with_tables("""
SELECT 'sbdb_structural_integrity' AS check_name, 'sbdb' AS dataset, CASE WHEN u AND r THEN 'PASSED' ELSE 'FAILED' END AS status,
  'grain_unique=' || u || ';referential_integrity=' || r AS metrics FROM (SELECT
  NOT EXISTS (SELECT 1 FROM cat GROUP BY snapshot_key, spkid HAVING count(*) > 1) AND NOT EXISTS (SELECT 1 FROM orb GROUP BY snapshot_key, spkid HAVING count(*) > 1) AS u,
  NOT EXISTS (SELECT spkid FROM orb UNION SELECT spkid FROM elm UNION SELECT spkid FROM phy EXCEPT SELECT spkid FROM cat) AS r)""", "cat", "orb", "elm", "phy"))
def _(spark, sf):
    return metrics_as_text(Q.structure_check(
        D.catalog_objects(spark, sf), D.orbits(spark, sf), D.elements(spark, sf), D.physical(spark, sf)))


@query("approach_window_violations", "Q11", with_tables("""
SELECT count(*) AS outside, (SELECT string_agg(d, ',' ORDER BY d) FROM (SELECT DISTINCT closest_approach_date AS d FROM apr
  WHERE closest_approach_date < '1995-02-01' OR closest_approach_date > '2001-06-30' ORDER BY d LIMIT 5)) AS first_dates
FROM apr WHERE closest_approach_date < '1995-02-01' OR closest_approach_date > '2001-06-30'""", "apr"))
def _(spark, sf):
    return Q.window_violations(D.approaches(spark, sf), F.lit("1995-02-01"), F.lit("2001-06-30"))


def _date_check(broken: str) -> str:
    return f"""SELECT 'source_partition_dates' AS check_name, 'pipeline_outputs' AS dataset, CASE WHEN {broken} THEN 'FAILED' ELSE 'PASSED' END AS status,
  'partition_dates_valid=' || (NOT ({broken})) AS metrics"""


_OUTSIDE = "EXISTS (SELECT 1 FROM apr WHERE closest_approach_date NOT BETWEEN '{}' AND '{}')"
_OFF_DAY = "EXISTS (SELECT 1 FROM {0} WHERE snapshot_key <> (SELECT {1}(snapshot_key) FROM {0}) OR substr(snapshot_time, 1, 10) <> (SELECT {1}(snapshot_key) FROM {0}))"
_FIRST_DAY = "(SELECT * FROM rsk WHERE snapshot_key = (SELECT min(snapshot_key) FROM rsk))"


@query("partition_date_checks", "Q11 Q12", with_tables(" UNION ALL ".join(_date_check(b) for b in (
    _OUTSIDE.format("1995-02-01", "2001-06-30") + " OR " + _OFF_DAY.format("rsk", "min"), _OUTSIDE.format("1992-01-01", "2001-12-31"),
    _OFF_DAY.format("rsk", "min"), _OFF_DAY.format(_FIRST_DAY, "min"), _OFF_DAY.format("cat", "max"))), "apr", "rsk", "cat"))
def _(spark, sf):
    """Window and days broken, a wide window, risk rows of many days, of their first day, and catalog rows off the last day."""
    rows, risk, objects = D.approaches(spark, sf), D.risk_snapshots(spark, sf), D.catalog_objects(spark, sf)
    first = risk.join(F.broadcast(risk.agg(F.min("snapshot_key").alias("snapshot_key"))), "snapshot_key", "left_semi")
    day = objects.agg(F.max("snapshot_key")).first()[0]
    return metrics_as_text(Q.union_checks([
        Q.partition_dates_check(spark, rows, "1995-02-01", "2001-06-30", risk), Q.partition_dates_check(spark, rows, "1992-01-01", "2001-12-31"),
        Q.partition_dates_check(spark, risk=risk), Q.partition_dates_check(spark, risk=first), Q.partition_dates_check(spark, objects=objects, object_date=day)]))


@query("crosswalk_checks", "Q13 Q14 J14", with_tables("""
SELECT 'crosswalk_bridge_invariants' AS check_name, 'crosswalk' AS dataset, CASE WHEN bad = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
  'bridge_rows=' || n || ';distinct_asteroid_keys=' || k || ';keys_with_invalid_pivots=' || bad || ';identifier_tuples_unique=true' AS metrics
FROM (SELECT sum(c)::BIGINT AS n, count(*) AS k, count(*) FILTER (p <> 1) AS bad FROM (SELECT asteroid_key, count(*) AS c, count(*) FILTER (is_primary_pivot) AS p FROM brg GROUP BY 1))
UNION ALL SELECT 'crosswalk_audit_invariants', 'crosswalk', CASE WHEN amb = 0 AND o = 0 THEN 'PASSED' ELSE 'FAILED' END,
  'audit_rows=' || n || ';run_count=1;ambiguous_records_count=' || amb || ';orphan_assigned_keys=' || o
FROM (SELECT count(*) AS n, count(*) FILTER (match_state = 'AMBIGUOUS') AS amb,
  count(*) FILTER (assigned_asteroid_key IS NOT NULL AND assigned_asteroid_key NOT IN (SELECT asteroid_key FROM brg)) AS o FROM aud)""", "brg", "aud"))
def _(spark, sf):
    bridge, audit = D.published_crosswalk(spark, sf)
    return metrics_as_text(Q.union_checks([Q.bridge_check(bridge), Q.audit_check(audit, bridge)]))


def _approach_summaries(spark, sf):
    """One summary per order date: lines received, lines of the urgent priorities counted as valid."""
    orders = D.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM")
    valid = F.count_if(F.substring("o_orderpriority", 1, 1) != "5")
    return orders.groupBy(day.alias("run_id")).agg(F.count(F.lit(1)).alias("records_received"), valid.alias("valid_records")).select(
        "run_id", "records_received", "valid_records", (F.col("records_received") - F.col("valid_records")).alias("skipped_records"),
        F.round((F.col("records_received") - F.col("valid_records")) / F.col("records_received") * 100, 2).alias("rejection_pct"),
        (F.substring("run_id", 6, 2) != "03").alias("gate_passed"))


_MONTHS = """(SELECT *, n - v AS s, round((n - v) / n * 100, 2) AS pct, substr(m, 6, 2) <> '03' AS g FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*) AS n,
  count(*) FILTER (substr(o_orderpriority, 1, 1) <> '5') AS v FROM orders GROUP BY 1))"""


@query("approach_summary_checks", "Q2", f"""
SELECT status, count(*) AS checks, sum(v)::BIGINT AS valid FROM (SELECT CASE WHEN g AND v > 0 AND pct < 20 THEN 'PASSED' ELSE 'FAILED' END AS status, v FROM {_MONTHS}) GROUP BY 1""")
def _(spark, sf):
    checks = Q.approach_summary_check(_approach_summaries(spark, sf))
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("checks"), F.sum(F.col("metrics")["valid_records"].cast("bigint")).alias("valid"))


@query("approach_lineage_checks", "Q3", f"""
SELECT g AS gate_passed, CASE WHEN NOT g THEN 'FAILED' WHEN v = (SELECT count(*) FROM orders) THEN 'PASSED' ELSE 'FAILED' END AS with_table,
  CASE WHEN g THEN 'FAILED' ELSE 'NOT_APPLICABLE' END AS without_table, count(*) AS runs FROM {_MONTHS} GROUP BY ALL""")
def _(spark, sf):
    summaries = _approach_summaries(spark, sf)
    present = Q.approach_lineage_check(summaries, D.approaches(spark, sf))
    absent = Q.approach_lineage_check(summaries, None)
    key = F.col("metrics")["summary_run_id"]
    gate = summaries.select("run_id", "gate_passed")
    with_table = present.select(key.alias("run_id"), F.col("status").alias("with_table")).join(gate, "run_id")
    states = absent.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    per_gate = with_table.groupBy("gate_passed", "with_table").agg(F.count(F.lit(1)).alias("runs"))
    without = F.when(F.col("gate_passed"), V.FAILED).otherwise(V.NOT_APPLICABLE)
    # Both sides must agree on how many runs are in each state.
    return per_gate.withColumn("without_table", without).join(
        states.withColumnRenamed("status", "without_table"), "without_table").select("gate_passed", "with_table", "without_table", "runs")


@query("approach_run_lineage", "Q3", """
SELECT run AS run_id, CASE WHEN NOT gate THEN 'FAILED' WHEN valid = n AND (run = '' OR run = 'run-' || (SELECT max(year(o_orderdate)) FROM orders)) THEN 'PASSED' ELSE 'FAILED' END AS status,
  n AS parquet_rows, 'run-' || (SELECT max(year(o_orderdate)) FROM orders) AS embedded_run_id
FROM (SELECT 'run-' || year(o_orderdate) AS run, (SELECT count(*) FROM orders) AS valid, year(o_orderdate) <> 1996 AS gate FROM orders GROUP BY year(o_orderdate)
  UNION ALL SELECT '', (SELECT count(*) FROM orders), true UNION ALL SELECT 'run-' || max(year(o_orderdate)), count(*) - 1, true FROM orders), (SELECT count(*) AS n FROM orders)""")
def _(spark, sf):
    """The table's run against summaries of other years, of its own, without a run, with a row less, and behind a failed gate."""
    years = D.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    total = years.agg(F.sum("n").alias("n"), F.max("y").alias("y")).first()
    run = F.concat(F.lit("run-"), F.col("y").cast("string"))
    summaries = years.select(run.alias("run_id"), F.lit(total.n).alias("valid_records"), (F.col("y") != 1996).alias("gate_passed")).unionByName(
        spark.createDataFrame([("", total.n, True), (f"run-{total.y}", total.n - 1, True)], "run_id string, valid_records bigint, gate_passed boolean"))
    runs = years.select(F.lit("asteroids").alias("table_name"), run.alias("run_id"))
    checks = Q.approach_lineage_check(summaries, D.approaches(spark, sf), runs)
    return checks.select(F.col("metrics")["summary_run_id"].alias("run_id"), "status", F.col("metrics")["parquet_rows"].cast("bigint").alias("parquet_rows"), F.col("metrics")["embedded_run_id"].alias("embedded_run_id"))


_TALLIES = f"""(SELECT *, s > 0 AND f / n < 0.25::DOUBLE AS passed, round(f / n * 100, 2) AS pct FROM (
SELECT 'all' AS run, count(*) AS n, count(*) FILTER (status = 'success') AS s, count(*) FILTER (status = 'failed') AS f, count(*) FILTER (status = 'duplicate') AS d FROM {_TARGETS}
UNION ALL SELECT 'mended', count(*), count(*) FILTER (status = 'success'), 0, count(*) FILTER (status = 'duplicate') FROM {_TARGETS} WHERE status <> 'failed'))"""


def _lineage_sql(table: str, rows: str) -> str:
    """Lineage of each run against `rows` stored objects; `table` is whether any is stored."""
    return f"""SELECT 'sbdb_ingestion_lineage' AS check_name, 'sbdb' AS dataset,
  CASE WHEN NOT passed THEN CASE WHEN {table} THEN 'FAILED' ELSE 'NOT_APPLICABLE' END WHEN {rows} = s THEN 'PASSED' ELSE 'FAILED' END AS status,
  'object_rows=' || coalesce(({rows})::VARCHAR, '') || ';summary_successful_targets=' || s AS metrics FROM {_TALLIES}"""


_STORED = f"(SELECT count(*) FROM {_TARGETS} WHERE status = 'success')"


@query("catalog_summary_checks", "Q7 Q8 K8", f"""
SELECT 'sbdb_circuit_breaker' AS check_name, 'sbdb' AS dataset, CASE WHEN passed THEN 'PASSED' ELSE 'FAILED' END AS status, 'total_targets=' || n || ';successful_targets_count=' || s
  || ';failed_targets_count=' || f || ';duplicate_targets_count=' || d || ';failure_rate_pct=' || pct || ';circuit_breaker_passed=' || passed || ';math_valid=true' AS metrics FROM {_TALLIES}
UNION ALL {_lineage_sql('false', 'NULL::BIGINT')} UNION ALL {_lineage_sql('true', _STORED)} UNION ALL {_lineage_sql('true', '(' + _STORED + ' - 1)')}""")
def _(spark, sf):
    """A run with its failures and one whose failed targets were withdrawn, without tables, with theirs, and with a row less."""
    # Written, as the summaries and the checks read them again.
    targets = materialize(_targets(spark, sf).select("snapshot_key", "run_id", "snapshot_time", "target", "spkid", "status"), "targets")
    summary = ingest.catalog_summary(targets).unionByName(ingest.catalog_summary(targets.filter("status <> 'failed'")))
    objects = targets.filter("status = 'success'").select("spkid")
    short = objects.join(F.broadcast(objects.agg(F.max("spkid").alias("spkid"))), "spkid", "left_anti")
    return metrics_as_text(Q.union_checks([
        Q.catalog_summary_check(summary), Q.catalog_lineage_check(summary, None, False), Q.catalog_lineage_check(summary, objects, True),
        Q.catalog_lineage_check(summary, short, True)]))


_ROLLED = f"""(SELECT 'summaries' AS checks, CASE WHEN g AND v > 0 AND pct < 20 THEN 'PASSED' ELSE 'FAILED' END AS status FROM {_MONTHS}
UNION ALL SELECT 'lineage', CASE WHEN g THEN 'FAILED' ELSE 'NOT_APPLICABLE' END FROM {_MONTHS}
UNION ALL SELECT 'payloads', CASE WHEN event_id % 89 IN (5, 6) OR event_id % 14 IN (0, 2, 3, 4, 5, 7, 10, 11) THEN 'FAILED' ELSE 'WARNING' END FROM events
UNION ALL SELECT 'blocked', 'BLOCKED' FROM {_MONTHS} WHERE NOT g UNION ALL SELECT 'sound payloads', 'WARNING' FROM events
  WHERE NOT (event_id % 89 IN (5, 6) OR event_id % 14 IN (0, 2, 3, 4, 5, 7, 10, 11)))"""


@query("check_roll_up", "Q16", f"""
SELECT checks, CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'FAILED' WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASSED' END AS overall_status,
  count(*) AS total_checks, count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'WARNING') AS warnings,
  count(*) FILTER (status = 'BLOCKED') AS blocked, count(*) FILTER (status = 'NOT_APPLICABLE') AS not_applicable FROM {_ROLLED} GROUP BY 1""")
def _(spark, sf):
    """Checks of every status, rolled up by where they come from."""
    months = _approach_summaries(spark, sf)
    payloads = Q.risk_gate(K.risk_tally(risk_entries(P.risk_payloads(spark, sf)), ["snapshot_key"]))
    as_checks = Q.check_row(payloads, "payload", "sentry", F.col("status"), F.lit(""))
    halted = Q.check_row(months.filter(~F.col("gate_passed")), "halted", "neows", F.lit(V.BLOCKED), F.lit(""))
    parts = {"summaries": Q.approach_summary_check(months), "lineage": Q.approach_lineage_check(months, None), "payloads": as_checks, "blocked": halted,
             "sound payloads": as_checks.filter(F.col("status") != V.FAILED)}
    rolled = [Q.roll_up(checks).withColumn("checks", F.lit(name)) for name, checks in parts.items()]
    return Q.union_checks(rolled)


@query("orphan_lines", "J14", """
SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def _(spark, sf):
    parents = D.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    lost = orphans(D.table(spark, sf, "lineitem").select("l_suppkey"), parents, "l_suppkey", "c_custkey")
    return lost.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("repeated_lines", "Q10 Q13", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    return duplicated_keys(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _exists(rows: str) -> str:
    return f"CASE WHEN EXISTS ({rows}) THEN 'FAILED' ELSE 'PASSED' END"


_STRUCTURE = _exists("""SELECT 1 FROM cat GROUP BY snapshot_key, spkid HAVING count(*) > 1 UNION ALL SELECT 1 FROM orb GROUP BY snapshot_key, spkid HAVING count(*) > 1
  UNION ALL SELECT 1 FROM (SELECT spkid FROM orb UNION SELECT spkid FROM elm UNION SELECT spkid FROM phy EXCEPT SELECT spkid FROM cat)""")
_FILLED = "(SELECT min(n) FROM (" + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in ("rsk", "cat", "orb", "elm", "phy")) + f" UNION ALL SELECT count(*) FROM {_ORD} WHERE v >= 14))"
_FOLDER_CHECKS = {
    "neows_gate_validation": f"CASE WHEN EXISTS (SELECT 1 FROM {_ORD} WHERE v >= 14) THEN 'PASSED' ELSE 'FAILED' END",
    "neows_parquet_lineage": f"CASE WHEN EXISTS (SELECT 1 FROM {_ORD} WHERE v >= 14) THEN 'PASSED' ELSE 'FAILED' END",
    "sentry_snapshot_validation": "(SELECT CASE WHEN count(*) > 0 AND count(*) = count(DISTINCT sentry_id) AND count(*) FILTER (impact_probability NOT BETWEEN 0 AND 1) = 0 THEN 'PASSED' ELSE 'FAILED' END FROM rsk)",
    "sbdb_circuit_breaker": "(SELECT CASE WHEN count(*) > 0 THEN 'PASSED' ELSE 'FAILED' END FROM cat)",
    "sbdb_ingestion_lineage": "(SELECT CASE WHEN count(*) > 0 THEN 'PASSED' ELSE 'FAILED' END FROM cat)",
    "pre_resolution_output_accounting": f"CASE WHEN {_FILLED} > 0 THEN 'PASSED' ELSE 'FAILED' END",
    "sbdb_structural_integrity": _STRUCTURE,
    "source_partition_dates": f"""CASE WHEN EXISTS (SELECT 1 FROM {_ORD} WHERE v >= 14 AND (d1 < '1992-01-01' OR d > '2001-12-31'))
  OR {_OFF_DAY.format('rsk', 'min')} OR {_OFF_DAY.format('cat', 'max')} THEN 'FAILED' ELSE 'PASSED' END""",
    "crosswalk_bridge_invariants": _exists("SELECT 1 FROM brg GROUP BY asteroid_key HAVING count(*) FILTER (is_primary_pivot) <> 1 UNION ALL SELECT 1 FROM brg GROUP BY source_system, identifier_name, identifier_value HAVING count(*) > 1"),
    "crosswalk_audit_invariants": _exists("SELECT 1 FROM aud WHERE match_state = 'AMBIGUOUS' OR assigned_asteroid_key NOT IN (SELECT asteroid_key FROM brg)"),
    "s3_publication_verification": f"CASE WHEN {_FILLED} > 0 THEN 'PASSED' ELSE 'FAILED' END",
    "storage_ready": f"CASE WHEN {_FILLED} > 0 THEN 'PASSED' ELSE 'FAILED' END",
    "older_storage_ready": "CASE WHEN (SELECT count(*) FROM cat) >= 0 THEN 'FAILED' END",
    "approach_rows": f"(SELECT (2 * count(*))::VARCHAR FROM {_ORD} WHERE v >= 14)",
    "objects_rows": "(SELECT count(*)::VARCHAR FROM cat)", "risk_rows": "(SELECT count(*)::VARCHAR FROM rsk)", "audit_rows": "(SELECT count(*)::VARCHAR FROM aud)",
    "empty_table_rows": "'0'", "older_name_rows": "(SELECT count(*)::VARCHAR FROM rsk)",
    "summary_received": f"(SELECT (2 * count(*))::VARCHAR FROM {_ORD} WHERE v >= 14)", "missing_summary_readable": "'false'",
}


@query("output_folder_suite", "Q9 Q15 Q17 Q18 S1 S2 S9 S10 K7 K8", with_tables(
    " UNION ALL ".join(f"SELECT '{name}' AS check_name, {status} AS status" for name, status in _FOLDER_CHECKS.items()),
    "rsk", "cat", "orb", "elm", "phy", "brg", "aud"))
def _(spark, sf):
    """The documents that pass their gate, replayed into an output folder with the other tables and the summaries
    of the runs; then every gate on the folder, and what its readers see of it."""
    folder = fresh_path(spark, "output")
    lake = D.lakehouse(spark, sf)
    documents = P.approach_payloads(spark, sf).withColumn("source_sha256", F.sha2("payload", 256))
    rows, gate = ingest.replay_payloads(documents)
    sinks.write_table_with_lineage(rows.drop("source_raw_file", "source_raw_sha256"), "asteroids", f"{folder}/asteroids.parquet", "r1", "2024-03-01", "neows")
    stored = {
        "fact_sentry_risk_snapshot": lake.risk, "fact_sbdb_object_snapshot": lake.objects, "fact_sbdb_orbit": lake.orbits, "fact_sbdb_orbit_element": lake.elements,
        "fact_sbdb_physical_parameter": lake.physical, "bridge_asteroid_identifier": lake.bridge, "fact_entity_resolution": lake.audit}
    for name, df in stored.items():
        sinks.write_table(df, name, f"{folder}/{name}.parquet")
    # Another folder has the risk table alone, under its older name.
    sinks.write_table(lake.risk, "fact_sentry_risk_snapshot", f"{folder}-older/sentry_risk_snapshot.parquet")
    sinks.write_report(ingest.approach_summary(gate.filter("gate_passed"), "r1", "1992-01-01", "2001-12-31"), f"{folder}/{Q.APPROACH_SUMMARY}")
    stored_objects = open_lakehouse(spark, folder).objects
    day = stored_objects.agg(F.max("snapshot_key")).first()[0]
    batch = stored_objects.select(
        F.lit(day).alias("snapshot_key"), F.lit("c1").alias("run_id"), F.lit(f"{day}T06:00:00Z").alias("snapshot_time"), F.lit("success").alias("status"))
    sinks.write_report(ingest.catalog_summary(batch), f"{folder}/{Q.CATALOG_SUMMARY}")
    keys = spark.createDataFrame([("asteroids.parquet",), (Q.APPROACH_SUMMARY,)], "key string")
    checks = Q.full_suite(spark, folder, publish_keys=keys, verify=True).select("check_name", "status")
    sinks.write_report(Q.roll_up(checks), f"{folder}/dq_result.json")
    lake = open_lakehouse(spark, folder)
    ready = lambda name, where: storage_ready(spark, where).agg(F.min("present").alias("ok")).select(
        F.lit(name).alias("check_name"), Q.verdict(F.col("ok")).alias("status"))
    counted = lambda name, df: df.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).cast("string").alias("status"))
    summary = read_summary(spark, f"{folder}/{Q.APPROACH_SUMMARY}", Q.APPROACH_SUMMARY_DDL).filter("readable")
    lost = read_summary(spark, f"{folder}/nothing.json", Q.APPROACH_SUMMARY_DDL)
    seen = [
        counted("approach_rows", lake.asteroids), counted("objects_rows", lake.objects), counted("risk_rows", lake.risk), counted("audit_rows", lake.audit),
        counted("empty_table_rows", open_lakehouse(spark, f"{folder}/nowhere").risk), counted("older_name_rows", open_lakehouse(spark, f"{folder}-older").risk),
        summary.select(F.lit("summary_received").alias("check_name"), F.col("records_received").cast("string").alias("status")),
        lost.select(F.lit("missing_summary_readable").alias("check_name"), F.col("readable").cast("string").alias("status"))]
    return Q.union_checks([checks, ready("storage_ready", folder), ready("older_storage_ready", f"{folder}-older"), *seen])


_RUN_STAGES = "(SELECT *, l_linenumber IS NOT NULL AND NOT (o_orderstatus = 'P' AND l_linenumber = 3) AS k FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)"


def _runs(spark, sf):
    """A run per order, a stage per line; some stages fail, the third one of a backfill doesn't count."""
    orders, lines = D.table(spark, sf, "orders"), D.table(spark, sf, "lineitem")
    run = F.concat(F.lit("r"), F.col("o_orderkey").cast("string"))
    runs = orders.select(
        run.alias("pipeline_run_id"), F.when(F.col("o_orderstatus") == "P", "historical_backfill").otherwise(" CURRENT_PRODUCTION").alias("execution_mode"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("started_at"), F.lit(None).cast("string").alias("completed_at"),
        (F.floor("o_totalprice") - 100000).cast("double").alias("duration_seconds"), F.lit(None).cast("string").alias("overall_status"))
    none = F.lit(None).cast("boolean")
    stages = lines.select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("pipeline_run_id"),
        F.when(F.col("l_linenumber") == 3, "sentry").otherwise(F.concat(F.lit("stage"), F.col("l_linenumber").cast("string"))).alias("stage"),
        F.when(F.col("l_returnflag") == "A", "failed").otherwise("ok").alias("status"),
        F.when(F.col("l_discount") > 0.05, False).alias("dq_gate_passed"), none.alias("failure_gate_passed"),
        none.alias("crosswalk_gate_passed"), none.alias("checks_passed"),
        F.array(F.concat(F.lit(" p/"), F.col("l_partkey").cast("string"), F.lit("?api_key=abc"))).alias("published_keys"),
        F.create_map(F.lit("Api_Token"), F.lit("x"), F.lit("note"), F.col("l_linestatus")).alias("details"))
    return runs, stages


@query("run_manifests", "A16 F32", f"""
SELECT 'r' || o_orderkey AS pipeline_run_id, CASE WHEN o_orderstatus = 'P' THEN 'HISTORICAL_BACKFILL' ELSE 'CURRENT_PRODUCTION' END AS execution_mode,
  CASE WHEN bool_or(k AND (l_returnflag = 'A' OR l_discount > 0.05)) THEN 'FAILED' ELSE 'SUCCESS' END AS overall_status,
  greatest(0, floor(max(o_totalprice)) - 100000) AS duration_seconds, count(*) FILTER (k) AS stage_count,
  coalesce(string_agg(DISTINCT 'p/' || l_partkey || '?api_key=REDACTED', ',' ORDER BY 'p/' || l_partkey || '?api_key=REDACTED') FILTER (k), '') AS published_keys,
  count(DISTINCT l_partkey) FILTER (k) AS published_key_count,
  'metadata/pipeline_runs/year=' || strftime(max(o_orderdate), '%Y/month=%m/day=%d') || '/run_manifest_r' || o_orderkey || '.json' AS manifest_path
FROM {_RUN_STAGES} GROUP BY o_orderkey, o_orderstatus""")
def _(spark, sf):
    return as_text(manifest.run_manifests(*_runs(spark, sf)), "published_keys").drop("schema_version", "started_at", "completed_at")


@query("manifest_keys", "A16 F6", f"""
SELECT DISTINCT 'r' || o_orderkey AS pipeline_run_id, 'p/' || l_partkey || '?api_key=REDACTED' AS key FROM {_RUN_STAGES} WHERE k""")
def _(spark, sf):
    return manifest.manifest_keys(*_runs(spark, sf))


@query("manifest_stages", "A16 F7", f"""
SELECT 'r' || o_orderkey AS pipeline_run_id, CASE WHEN l_linenumber = 3 THEN 'sentry' ELSE 'stage' || l_linenumber END AS stage,
  CASE WHEN l_returnflag = 'A' THEN 'FAILED' ELSE 'OK' END AS status, l_returnflag = 'A' OR l_discount > 0.05 AS failed,
  CASE WHEN l_discount > 0.05 THEN false END AS dq_gate_passed, 1 AS kept_details, l_linestatus AS note FROM {_RUN_STAGES} WHERE k""")
def _(spark, sf):
    rows = manifest.manifest_stages(*_runs(spark, sf))
    return rows.select("pipeline_run_id", "stage", "status", "failed", "dq_gate_passed", F.size("details").alias("kept_details"), F.col("details")["note"].alias("note"))
