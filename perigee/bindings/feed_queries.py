"""Extraction from raw documents, validation of fetched records, writers and replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.bindings import domain as D
from perigee.bindings import payloads as P
from perigee.bindings.identity_queries import _profile, _world
from perigee.bindings.registry import as_text, query
from perigee.bindings.sql import with_tables
from perigee.operators import extract_approaches as A
from perigee.operators import extract_catalog as C
from perigee.operators import extract_risk as K
from perigee.operators.validation import validate_profiles, validate_responses, validate_world
from perigee.plans import ingest, world
from perigee.plans.quality import approach_gate, catalog_gate, risk_gate
from perigee.runtime import fresh_path
from perigee.sources import sinks
from perigee.sources.sinks import dataset_lineage
from perigee.sources.raw import approach_entries, approach_records, risk_entries, risk_records
from perigee.sources.tables import read_csv, read_partitioned, read_table
from perigee.sources.targets import clean_targets

# --- close approaches ----------------------------------------------------------------------------

_OK = "v NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8)"
# Every 97th document is cut short and the next one holds no record; variants 14 and 15 send no copy.
_KEPT = "o_orderkey % 97 NOT IN (3, 4)"
_ALL = "(SELECT *, o_orderkey % 16 AS v, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate::DATE - 1, '%Y-%m-%d') AS d1 FROM orders)"
_ORD = f"(SELECT * FROM {_ALL} WHERE {_KEPT})"


def _approach_row(ident: str, day: str, broken: bool) -> str:
    v = "v" if broken else "15"
    return f"""
SELECT '{ident}' || o_orderkey AS id, 'N ' || o_orderkey AS name, {day} AS closest_approach_date, o_totalprice AS miss_distance_km,
  o_orderstatus = 'F' AS hazardous, CASE WHEN {v} <> 12 THEN d || 'T07:18' END AS close_approach_datetime,
  CASE WHEN {v} <> 11 THEN o_orderkey * 1000 END AS close_approach_epoch_ms, CASE WHEN {v} <> 10 THEN 12.5::DOUBLE END AS relative_velocity_km_s,
  21.5::DOUBLE AS absolute_magnitude_h, CASE WHEN {v} <> 9 THEN o_totalprice / 1e6 END AS estimated_diameter_min_km,
  CASE WHEN {v} <> 9 THEN o_totalprice / 4e5 END AS estimated_diameter_max_km, CASE WHEN {v} <> 13 THEN false END AS is_sentry_object
FROM {_ORD}"""


def _approach_records(spark, sf):
    return approach_records(P.approach_payloads(spark, sf))


@query("raw_approach_rows", "P1 P2 S5 F5 F8", f"{_approach_row('7', 'd', True)} WHERE {_OK} UNION ALL {_approach_row('8', 'd1', False)}")
def _(spark, sf):
    return A.accepted_approaches(_approach_records(spark, sf), ["source_file"]).drop("source_file")


@query("raw_approach_verdicts", "P1", f"""
SELECT reject_reason, count(*) AS records FROM (
SELECT CASE v WHEN 0 THEN 'missing_id' WHEN 1 THEN 'missing_name' WHEN 2 THEN 'missing_approach' WHEN 3 THEN 'missing_date' WHEN 4 THEN 'invalid_date'
  WHEN 5 THEN 'missing_distance' WHEN 6 THEN 'invalid_distance' WHEN 7 THEN 'distance_not_positive' WHEN 8 THEN 'hazard_flag_not_boolean'
  ELSE CASE WHEN copy = 1 THEN 'duplicate' END END AS reject_reason FROM {_ORD}, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR v < 14
UNION ALL SELECT NULL FROM {_ORD}) GROUP BY 1""")
def _(spark, sf):
    return A.classified_approaches(_approach_records(spark, sf), ["source_file"]).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("records"))


@query("approach_gate", "Q1 S5", f"""
SELECT CASE WHEN NOT {_KEPT} THEN 0 WHEN {_OK} THEN 2 ELSE 1 END::BIGINT AS valid_records,
  CASE WHEN NOT {_KEPT} OR v >= 14 THEN 0 WHEN {_OK} THEN 1 ELSE 2 END::BIGINT AS skipped_records,
  round(CASE WHEN NOT {_KEPT} OR v >= 14 THEN 0 WHEN {_OK} THEN 1 ELSE 2 END / 3 * 100.0::DOUBLE, 2) AS rejection_pct,
  {_KEPT} AND v >= 14 AS gate_passed, CASE o_orderkey % 97 WHEN 3 THEN 'unreadable' WHEN 4 THEN 'empty' END AS defect, count(*) AS payloads
FROM {_ALL} GROUP BY ALL""")
def _(spark, sf):
    gate = approach_gate(A.approach_tally(approach_entries(P.approach_payloads(spark, sf)), ["source_file"]))
    return gate.groupBy("valid_records", "skipped_records", "rejection_pct", "gate_passed", "defect").agg(F.count(F.lit(1)).alias("payloads"))


# --- risk ----------------------------------------------------------------------------------------

_ALL_EV = "(SELECT *, event_id % 14 AS v FROM events)"
_EV = f"(SELECT * FROM {_ALL_EV} WHERE event_id % 89 NOT IN (5, 6))"


def _risk_records(spark, sf):
    return risk_records(P.risk_payloads(spark, sf))


@query("raw_risk_rows", "P3 S7", f"""
SELECT '2024-03-01#' || event_id AS snapshot_key, 'raw-1' AS run_id, '2024-03-01T00:00:00Z' AS snapshot_time, 'e' || event_id AS sentry_id,
  'D ' || user_id AS designation, CASE WHEN v = 8 THEN 'D ' || user_id ELSE '(Full)' END AS fullname, CASE WHEN v <> 6 THEN 20.25::DOUBLE END AS absolute_magnitude,
  0.31::DOUBLE AS estimated_diameter_km, CASE WHEN v = 1 THEN 1 ELSE 4.5e-07 END AS impact_probability, CASE WHEN v = 12 THEN 7 ELSE 5 END::BIGINT AS potential_impacts_count,
  -3.25::DOUBLE AS palermo_scale_cum, value AS palermo_scale_max, 0::BIGINT AS torino_scale_max, 17.25::DOUBLE AS v_infinity_km_s,
  CASE WHEN v = 9 THEN '' ELSE '2061-2094' END AS impact_year_range, strftime(ts, '%Y-%m-%d') AS last_obs_date, 2455555.5::DOUBLE AS last_obs_jd
FROM {_EV} WHERE v NOT IN (0, 2, 3, 4, 5, 7, 10, 11)""")
def _(spark, sf):
    return K.accepted_risk(_risk_records(spark, sf), ["snapshot_key", "run_id", "snapshot_time"])


@query("raw_risk_verdicts", "P3", f"""
SELECT reject_reason, count(*) AS records FROM (
SELECT CASE WHEN v IN (0, 2) THEN 'impact_probability' WHEN v = 3 THEN 'potential_impacts_count' WHEN v = 4 THEN 'torino_scale' WHEN v = 5 THEN 'v_infinity'
  WHEN v = 7 THEN 'absolute_magnitude' WHEN v = 10 THEN 'last_obs' WHEN v = 11 THEN 'missing_identifier' ELSE CASE WHEN copy = 1 THEN 'duplicate' END END AS reject_reason
FROM {_EV}, (SELECT unnest([0, 1]) AS copy) UNION ALL SELECT 'missing_identifier' FROM {_EV}) GROUP BY 1""")
def _(spark, sf):
    return K.classified_risk(_risk_records(spark, sf), ["snapshot_key"]).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query("risk_gate", "Q5 S7", f"""
SELECT valid AS valid_records, received - valid AS skipped_records, CASE WHEN received = 0 THEN 0.0 ELSE round((received - valid) / received * 100.0::DOUBLE, 2) END AS rejection_pct,
  CASE WHEN valid = 0 THEN 'FAILED' ELSE 'WARNING' END AS status, CASE event_id % 89 WHEN 5 THEN 'unreadable' WHEN 6 THEN 'empty' END AS defect, count(*) AS payloads
FROM (SELECT event_id, CASE WHEN event_id % 89 IN (5, 6) THEN 0 ELSE 3 END::BIGINT AS received,
  CASE WHEN event_id % 89 IN (5, 6) OR v IN (0, 2, 3, 4, 5, 7, 10, 11) THEN 0 ELSE 1 END::BIGINT AS valid FROM {_ALL_EV}) GROUP BY ALL""")
def _(spark, sf):
    gate = risk_gate(K.risk_tally(risk_entries(P.risk_payloads(spark, sf)), ["snapshot_key"]))
    return gate.groupBy("valid_records", "skipped_records", "rejection_pct", "status", "defect").agg(F.count(F.lit(1)).alias("payloads"))


# --- catalog -------------------------------------------------------------------------------------

_RUN_SCOPE = ["snapshot_key", "run_id", "snapshot_time"]
# Defects by v: 0 no spkid, 2 no designation, 8 no class name; 10 negative e, 12 epoch, 14 n_obs, 16 rms, 18 no elements, 19 repeated parameter.
_PART = """(SELECT *, p_partkey % 20 AS v, 'T' || lpad(p_partkey::VARCHAR, 10, '0') AS target, '9' || (p_partkey // 2) AS spkid,
  p_partkey % 20 IN (0, 2, 8) AS bad_object, p_partkey % 20 IN (0, 2, 8, 10, 12, 14, 16, 18, 19) AS bad FROM part)"""
_TARGETS = f"""(SELECT *, CASE WHEN bad_object OR w IS NULL OR target < w THEN 'failed' WHEN target = w THEN 'success' ELSE 'duplicate' END AS status
  FROM (SELECT *, min(target) FILTER (NOT bad) OVER (PARTITION BY spkid) AS w FROM {_PART}))"""
_HEAD = "'2024-03-01' AS snapshot_key, 'raw-1' AS run_id, '2024-03-01T00:00:00Z' AS snapshot_time, spkid"


def _targets(spark, sf):
    return C.classify_targets(P.catalog_documents(spark, sf), _RUN_SCOPE)


@query("catalog_targets", "P9 S6", f"SELECT target, status FROM {_TARGETS}")
def _(spark, sf):
    return _targets(spark, sf).select("target", "status")


@query("catalog_object_rows", "P4 P5 P9 F29", f"""
SELECT {_HEAD}, 'P' || p_partkey AS designation, CASE WHEN v = 4 THEN 'P' || p_partkey ELSE p_name END AS fullname, NULL::VARCHAR AS shortname,
  CASE WHEN v = 4 THEN 'unknown' ELSE 'an' END AS object_kind, CASE WHEN v NOT IN (5, 6) THEN true END AS is_neo, p_size > 25 AS is_pha, 'APO' AS orbit_class_code,
  p_brand AS orbit_class_name, '14' AS orbit_id, NULL::VARCHAR AS prefix, CASE WHEN v = 5 THEN NULL WHEN v = 6 THEN '' ELSE 'alt ' || p_partkey || ',plain' END AS alternate_designations
FROM {_TARGETS} WHERE status = 'success'""")
def _(spark, sf):
    return as_text(C.object_rows(_targets(spark, sf)), "alternate_designations")


@query("catalog_orbit_rows", "P6", f"""
SELECT {_HEAD}, '14' AS orbit_id, 2461000.5::DOUBLE AS epoch_jd, 'J2000' AS equinox, '' AS soln_date, 'JPL' AS orbit_source, NULL::VARCHAR AS producer, '' AS first_obs,
  '' AS last_obs, 3844::BIGINT AS data_arc_days, p_size::BIGINT AS n_obs_used, CASE WHEN v = 7 THEN 'unknown' ELSE '1' END AS condition_code, 0.42::DOUBLE AS rms,
  0.01::DOUBLE AS earth_moid_au, CASE WHEN v <> 5 THEN 2.5::DOUBLE END AS jupiter_moid_au, NULL::DOUBLE AS t_jup, NULL::VARCHAR AS pe_used, NULL::VARCHAR AS sb_used
FROM {_TARGETS} WHERE status = 'success'""")
def _(spark, sf):
    return C.orbit_rows(_targets(spark, sf))


@query("catalog_element_rows", "P7", f"""
SELECT {_HEAD}, '14' AS orbit_id, 2461000.5::DOUBLE AS epoch_jd, 'J2000' AS equinox, n AS element_name, CASE n WHEN 'e' THEN ('0.' || p_size)::DOUBLE ELSE p_retailprice END AS element_value,
  0.1::DOUBLE AS sigma, 'au' AS units, NULL::VARCHAR AS title, NULL::VARCHAR AS label FROM {_TARGETS}, (SELECT unnest(['e', 'a']) AS n) WHERE status = 'success'""")
def _(spark, sf):
    return C.element_rows(_targets(spark, sf))


@query("catalog_parameter_rows", "P8", f"""
SELECT spkid, n AS param_name, CASE n WHEN 'H' THEN p_retailprice END AS param_value_numeric, CASE n WHEN 'extent' THEN '1 x 2' END AS raw_if_text, 'R1' AS bib_reference
FROM {_TARGETS}, (SELECT unnest(['H', 'extent']) AS n) WHERE status = 'success'""")
def _(spark, sf):
    rows = C.parameter_rows(_targets(spark, sf))
    return rows.select("spkid", "param_name", "param_value_numeric",
                       F.when(F.col("param_value_numeric").isNull(), F.col("param_value_raw")).alias("raw_if_text"), "bib_reference")


@query("catalog_gate", "Q6", f"""
SELECT *, round(failed_targets_count / total_targets * 100.0::DOUBLE, 2) AS failure_rate_pct, successful_targets_count > 0 AND failed_targets_count / total_targets < 0.25::DOUBLE AS circuit_breaker_passed
FROM (SELECT 'raw-1' AS run_id, count(*) AS total_targets, count(*) FILTER (status = 'success') AS successful_targets_count, count(*) FILTER (status = 'failed') AS failed_targets_count,
  count(*) FILTER (status = 'duplicate') AS duplicate_targets_count FROM {_TARGETS})""")
def _(spark, sf):
    return catalog_gate(C.batch_tally(_targets(spark, sf), ["run_id"]))


@query("target_list", "S11", """
SELECT DISTINCT target FROM (SELECT trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS target FROM part) WHERE target <> '' ORDER BY target""")
def _(spark, sf):
    raw = D.table(spark, sf, "part").select(F.concat(F.lit(" ( "), F.regexp_replace("p_name", " ", "   "), F.lit(") ")).alias("target"))
    return clean_targets(raw)


# --- validation ----------------------------------------------------------------------------------

@query("world_validation", "P13", with_tables("""
SELECT reason, count(*) AS records FROM (SELECT CASE WHEN NOT regexp_full_match(neows_id, '[1-9][0-9]*') THEN 'neows_id: no id'
  WHEN name IS NULL THEN 'name: no text' WHEN match_state = 'AMBIGUOUS' THEN 'encounter.miss_distance_km: no positive'
  WHEN match_state = 'UNRESOLVED' THEN 'neows_id: repeated' END AS reason, unnest(CASE WHEN match_state = 'UNRESOLVED' THEN [1, 2] ELSE [1] END)
FROM wld) GROUP BY 1""", "wld"))
def _(spark, sf):
    records = world.world_records(_world(spark, sf))
    # Ambiguous records get a distance that is text; unresolved ones are sent twice.
    broken = F.when(F.col("resolution.match_state") == "AMBIGUOUS", F.regexp_replace(
        F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}), r'"miss_distance_km":([0-9.E]+)', '"miss_distance_km":"$1"'))
    sent = records.select(
        F.coalesce(broken, F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})).alias("record_json"),
        F.explode(F.when(F.col("resolution.match_state") == "UNRESOLVED", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return validate_world(sent.select("record_json")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@query("profile_validation", "P14", with_tables("""
SELECT reason, count(*) AS records FROM (SELECT CASE WHEN match_state = 'UNRESOLVED' THEN 'encounter.is_sentry_object: no boolean'
  WHEN match_state = 'AMBIGUOUS' THEN 'physical: no object' END AS reason FROM wld) GROUP BY 1""", "wld"))
def _(spark, sf):
    profiles = _profile(spark, sf)
    text = F.to_json(F.struct(*profiles.columns), {"ignoreNullFields": "false"})
    state = F.col("identity.match_state")
    sent = (
        F.when(state == "UNRESOLVED", F.regexp_replace(text, r'"is_sentry_object":(true|false|null)', '"is_sentry_object":"yes"'))
        .when(state == "AMBIGUOUS", F.regexp_replace(text, r'"physical":', '"other":')).otherwise(text)
    )
    return validate_profiles(profiles.select(sent.alias("record_json"))).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


_ENVELOPES = """CASE right(k, 1) WHEN '0' THEN 'data: no list' WHEN '1' THEN 'world.object_count: no integer'
  WHEN '2' THEN 'world.spatial_model.direction_algorithm: not supported' WHEN '3' THEN 'world.spatial_model.direction_semantics: unknown value'
  WHEN '4' THEN 'response: no object' WHEN '5' THEN 'world.neows: no object' END"""
_SENT = f"""(SELECT *, {_ENVELOPES} AS e FROM (SELECT left(neows_id, greatest(0, length(neows_id) - 2)) AS k, neows_id, name, match_state,
  unnest(CASE WHEN match_state = 'UNRESOLVED' THEN [1, 2] ELSE [1] END) FROM wld))"""


def _responses(spark, sf):
    """World responses of at most a hundred objects (ids that differ in the last two signs); the sign before
    decides what is wrong with the envelope. Unresolved objects are sent twice."""
    records = world.world_records(_world(spark, sf))
    k = F.expr("left(neows_id, greatest(0, length(neows_id) - 2))")
    sent = records.select(
        k.alias("response_id"), F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("record_json"),
        F.explode(F.when(F.col("resolution.match_state") == "UNRESOLVED", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    # A response is bounded: a hundred ids, each twice at most.
    lists = sent.groupBy("response_id").agg(F.array_join(F.sort_array(F.collect_list("record_json")), ",").alias("items"))
    case = F.expr("right(response_id, 1)")
    lake = D.lakehouse(spark, sf)
    head = world.world_envelope(world.world_info(lake.asteroids.select(F.lit("x").alias("sentry_latest_catalog_snapshot_key")), [], dataset_lineage(
        spark.createDataFrame([("asteroids", "r1", "2024-03-01", "neows", "raw.json", "00")], sinks.RUN_TABLE_DDL))))
    text = F.col("world_json")
    text = (
        F.when(case == "1", F.regexp_replace(text, r'"object_count":([0-9]+)', '"object_count":"$1"'))
        .when(case == "2", F.replace(text, F.lit("-v1"), F.lit("-v2"))).when(case == "3", F.replace(text, F.lit('"illustrative"'), F.lit('"measured"')))
        .when(case == "5", F.replace(text, F.lit('"neows":'), F.lit('"other":'))).otherwise(text))
    body = F.when(case == "0", F.concat(F.lit('{"world":'), text, F.lit(',"data":{"items":['), "items", F.lit("]}}"))).when(
        case == "4", F.concat(F.lit("["), "items", F.lit("]"))).otherwise(F.concat(F.lit('{"world":'), text, F.lit(',"data":['), "items", F.lit("]}")))
    return lists.crossJoin(F.broadcast(head)).select("response_id", body.alias("response_json"))


@query("response_envelopes", "P13", with_tables(f"""
SELECT e AS envelope_reason, count(*) AS responses, sum(n)::BIGINT AS received FROM (
SELECT k, e, CASE WHEN e IN ('data: no list', 'response: no object') THEN 0 ELSE count(*) END AS n FROM {_SENT} GROUP BY k, e) GROUP BY 1""", "wld"))
def _(spark, sf):
    return validate_responses(_responses(spark, sf))[0].groupBy("envelope_reason").agg(F.count(F.lit(1)).alias("responses"), F.sum("received").alias("received"))


@query("response_records", "P13", with_tables(f"""
SELECT neows_id, CASE WHEN e IS NOT NULL THEN 'envelope: ' || e WHEN NOT regexp_full_match(neows_id, '[1-9][0-9]*') THEN 'neows_id: no id' WHEN name IS NULL THEN 'name: no text'
  WHEN match_state = 'UNRESOLVED' THEN 'neows_id: repeated' END AS reason, count(*) AS records
FROM {_SENT} WHERE e IS NULL OR e NOT IN ('data: no list', 'response: no object') GROUP BY 1, 2""", "wld"))
def _(spark, sf):
    return validate_responses(_responses(spark, sf))[1].groupBy("neows_id", "reason").agg(F.count(F.lit(1)).alias("records"))


# --- writers, read back --------------------------------------------------------------------------

@query("partitioned_risk_roundtrip", "K1 K4 S3 F32", with_tables("""
SELECT year, month, count(*) AS n, min(day) AS first_day, max(sentry_id) AS last_id, max(impact_probability) AS top
FROM (SELECT *, substr(snapshot_key, 1, 4) AS year, substr(snapshot_key, 6, 2) AS month, substr(snapshot_key, 9, 2) AS day FROM rsk) GROUP BY 1, 2""", "rsk"))
def _(spark, sf):
    root = fresh_path(spark, "risk")
    sinks.publish(D.risk_snapshots(spark, sf), root, F.col("snapshot_key"))
    rows = read_partitioned(spark, root, "fact_sentry_risk_snapshot")
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("sentry_id").alias("last_id"),
        F.max("impact_probability").alias("top"))


@query("approach_csv_roundtrip", "K3 S4", with_tables(
    "SELECT id, name, closest_approach_date, miss_distance_km, hazardous FROM apr", "apr"))
def _(spark, sf):
    path = fresh_path(spark, "csv")
    sinks.write_csv(D.approaches(spark, sf), path)
    return read_csv(spark, path)


@query("lineage_table_roundtrip", "K2 F33", with_tables("""
SELECT count(*) AS n, sum(close_approach_epoch_ms)::BIGINT AS epochs, 'run-9' AS run_id, '2024-03-01' AS ingested_at, 'orders' AS source FROM apr""", "apr"))
def _(spark, sf):
    path = fresh_path(spark, "approaches")
    rows = D.approaches(spark, sf).drop("year", "month", "day")
    sinks.write_table_with_lineage(rows, "asteroids", path, "run-9", "2024-03-01", "orders")
    runs = spark.read.parquet(f"{path}_runs").select("run_id", "ingested_at", "source")
    stored = read_table(spark, path, "asteroids").agg(F.count(F.lit(1)).alias("n"), F.sum("close_approach_epoch_ms").alias("epochs"))
    return stored.crossJoin(F.broadcast(runs))


@query("relational_load", "K5", with_tables("""
SELECT 'approach' AS stored, id AS asteroid_id, closest_approach_date AS approach_date, miss_distance_km, NULL AS name, NULL::BOOLEAN AS hazardous, 0 AS added_again FROM apr
QUALIFY row_number() OVER (PARTITION BY id, closest_approach_date ORDER BY miss_distance_km) = 1
UNION ALL SELECT 'asteroid', id, NULL, NULL, name, hazardous, 0 FROM apr QUALIFY row_number() OVER (PARTITION BY id ORDER BY name NULLS FIRST, hazardous NULLS FIRST) = 1""", "apr"))
def _(spark, sf):
    """Both tables as they stand after the rows were loaded twice, and how many rows the second load added."""
    folder = fresh_path(spark, "relational")
    rows = D.approaches(spark, sf)
    sinks.load_relational(spark, rows, folder)
    added = sum(t.count() for t in sinks.load_relational(spark, rows, folder))
    none = lambda kind: F.lit(None).cast(kind)
    children = read_table(spark, f"{folder}/close_approaches", "relational_close_approaches").select(
        F.lit("approach").alias("stored"), "asteroid_id", "approach_date", "miss_distance_km", none("string").alias("name"), none("boolean").alias("hazardous"))
    parents = read_table(spark, f"{folder}/asteroids", "relational_asteroids").select(
        F.lit("asteroid").alias("stored"), "asteroid_id", none("string").alias("approach_date"), none("double").alias("miss_distance_km"), "name", "hazardous")
    return children.unionByName(parents).withColumn("added_again", F.lit(added))


@query("raw_replay", "S8 K6 F6 Q1", f"""
SELECT count(*) AS table_rows, sum(o_totalprice) > 0 AS distances, count(DISTINCT o_orderkey) AS documents,
  (SELECT count(*) FROM {_ALL} WHERE NOT ({_KEPT} AND v >= 14)) AS refused
FROM {_ORD}, (SELECT unnest([0, 1]) AS record) WHERE v >= 14""")
def _(spark, sf):
    # The redacted documents are written as packed text lines, and each line is replayed as a file would be.
    path = fresh_path(spark, "raw")
    sinks.write_raw(P.approach_payloads(spark, sf), path, packed=True)
    lines = spark.read.text(path).select(
        F.concat(F.lit("replay/"), F.sha2("value", 256)).alias("source_file"), F.sha2("value", 256).alias("source_sha256"), F.col("value").alias("payload"))
    rows, gate = ingest.replay_payloads(lines)
    stored = rows.agg(F.count(F.lit(1)).alias("table_rows"), (F.sum("miss_distance_km") > 0).alias("distances"),
                      F.countDistinct("source_raw_sha256").alias("documents"))
    return stored.crossJoin(F.broadcast(gate.agg(F.count_if(~F.col("gate_passed")).alias("refused"))))
