"""Crosswalk, catalog, watchlists, world and dossiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.bindings import domain as D
from perigee.bindings.registry import as_text, query
from perigee.bindings.sql import _OPTIONAL, _RISK_ASSESSMENT, key_of, with_tables
from perigee.functions.availability import dominant_reason
from perigee.operators.resolution import resolution_metrics, metrics_breakdown
from perigee.operators.picking import newest_partition
from perigee.operators.tallying import keys_per_identifier
from perigee.plans import catalog, cross_source, dossier, watchlist, world
from perigee.plans.risk_history import risk_metric_history
from perigee.runtime import fresh_path
from perigee.sources.runs import append_run, read_latest_run, read_runs
from perigee.sources.sinks import dataset_lineage


@query("entity_bridge", "C1 U2 U3 F3 J13", with_tables("SELECT * FROM brg", "brg"))
def _(spark, sf):
    return D.published_crosswalk(spark, sf)[0]


@query("entity_audit", "C1 U2 U4 F1 F2 F30 J13", with_tables("SELECT * FROM aud", "aud"))
def _(spark, sf):
    return D.published_crosswalk(spark, sf)[1]


@query("resolution_candidates", "C1 J13", with_tables(f"""
SELECT alias, spk AS spkid, {key_of('spk')} AS asteroid_key, count(*) FILTER (kind = 'des') AS des_entities,
  bool_or(kind = 'fullname') AS by_fullname, bool_or(kind = 'alternate') AS by_alternate FROM ali GROUP BY alias, spk""", "ali"))
def _(spark, sf):
    return spark.read.parquet(f"{D.crosswalk_folder(spark, sf)}/alias_candidates.parquet")


@query("resolution_links", "C1 J13 F30", with_tables("SELECT * FROM clk", "clk"))
def _(spark, sf):
    return spark.read.parquet(f"{D.crosswalk_folder(spark, sf)}/candidate_links.parquet")


@query("resolution_metrics", "A14", with_tables("""
SELECT *, round(resolved_count / total_evaluated * 100, 2) AS resolution_rate_pct, (SELECT count(*) FROM brg) AS bridge_records_emitted FROM (
SELECT count(*) AS total_evaluated, count(*) FILTER (match_state = 'RESOLVED') AS resolved_count,
  count(*) FILTER (match_state = 'UNRESOLVED') AS unresolved_count, count(*) FILTER (match_state = 'AMBIGUOUS') AS ambiguous_count,
  count(*) FILTER (match_state = 'INVALID') AS invalid_count FROM aud)""", "aud", "brg"))
def _(spark, sf):
    bridge, audit = D.published_crosswalk(spark, sf)
    return resolution_metrics(audit, bridge)


@query("resolution_breakdown", "A14", with_tables("""
SELECT 'source' AS dimension, source_system AS value, count(*) AS evaluations FROM aud GROUP BY 2
UNION ALL SELECT 'state', match_state, count(*) FROM aud GROUP BY 2 UNION ALL SELECT 'rule', match_rule, count(*) FROM aud GROUP BY 2""", "aud"))
def _(spark, sf):
    return metrics_breakdown(D.published_crosswalk(spark, sf)[1])


@query("keys_per_customer_status", "A12 A6", """
SELECT o_custkey::VARCHAR AS id, count(DISTINCT o_orderstatus) AS key_count, min(o_orderstatus) AS first_key,
  CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN max(o_orderstatus) END AS sole_key FROM orders GROUP BY 1""")
def _(spark, sf):
    rows = D.table(spark, sf, "orders").select(
        F.lit("orders").alias("source_system"), F.lit("id").alias("identifier_name"),
        F.col("o_custkey").cast("string").alias("identifier_value"), F.col("o_orderstatus").alias("asteroid_key"))
    return keys_per_identifier(rows, "orders", "id", "id").select(
        "id", "key_count", "first_key", F.when(F.col("key_count") == 1, F.col("last_key")).alias("sole_key"))


@query("characterization_profile", "C6 W1 A5 J4 F10 F11", with_tables("SELECT * FROM chp", "chp"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    out = catalog.characterization_profile(lake.objects, lake.orbits, lake.elements, lake.physical, lake.bridge)
    return out.withColumn("orbital_period_yr", F.round("orbital_period_yr", 9))


@query("coherent_snapshot", "C13 U1 W1", with_tables("SELECT * FROM anc", "anc"))
def _(spark, sf):
    return catalog.coherent_snapshot(D.catalog_objects(spark, sf), D.orbits(spark, sf))


_ELEMENTS = ", ".join(f"e.c{i} AS {c}" for i, c in enumerate(catalog.PROFILE_ELEMENTS))
_ELEMENT_PICKS = ", ".join(
    f"max(element_value) FILTER (element_name = '{n}') AS c{i}" for i, n in enumerate(catalog.PROFILE_ELEMENTS.values()))
_ORBIT_TAIL = ", ".join(f"r.{c}" for c in catalog.ORBIT_FIELDS if c not in ("epoch_jd", "equinox"))
_PROFILE = f"""
SELECT a.spkid, p.asteroid_key, {', '.join('o.' + c for c in catalog.OBJECT_FIELDS)}, a.snapshot_key, a.run_id, a.snapshot_time,
  coalesce(nullif(r.orbit_id, ''), o.orbit_id) AS orbit_id, r.epoch_jd, coalesce(nullif(r.equinox, ''), e.eq) AS equinox, {_ORBIT_TAIL},
  {_ELEMENTS}, e.c9 / 365.25::DOUBLE AS orbital_period_yr, h.d AS estimated_diameter_km, h.h AS absolute_magnitude, h.al AS albedo, h.ro AS rotational_period_hr,
  CASE WHEN coalesce(r.data_arc_days::VARCHAR, r.n_obs_used::VARCHAR, r.condition_code) IS NULL THEN 'UNREPORTED'
    WHEN TRY_CAST(r.condition_code AS INT) < 5 AND r.data_arc_days >= 30 AND r.n_obs_used >= 20 THEN 'ADEQUATELY_CONSTRAINED'
    ELSE 'FOLLOWUP_PRIORITY_LIMITED_ARC' END AS astrometric_data_quality_tier
FROM anc a JOIN (SELECT identifier_value AS spkid, asteroid_key FROM brg WHERE is_primary_pivot) p USING (spkid)
LEFT JOIN (SELECT * FROM cat QUALIFY row_number() OVER (PARTITION BY spkid, snapshot_key, run_id ORDER BY orbit_id DESC) = 1) o USING (spkid, snapshot_key, run_id)
LEFT JOIN (SELECT * FROM orb QUALIFY row_number() OVER (PARTITION BY spkid, snapshot_key, run_id ORDER BY orbit_id DESC) = 1) r USING (spkid, snapshot_key, run_id)
LEFT JOIN (SELECT spkid, snapshot_key, run_id, orbit_id, {_ELEMENT_PICKS}, max(equinox) AS eq FROM elm GROUP BY ALL) e
  ON e.spkid = a.spkid AND e.snapshot_key = a.snapshot_key AND e.run_id = a.run_id AND e.orbit_id = r.orbit_id
LEFT JOIN (SELECT spkid, snapshot_key, run_id, max(param_value_numeric) FILTER (param_name = 'diameter') AS d,
  max(param_value_numeric) FILTER (param_name = 'H') AS h, max(param_value_numeric) FILTER (param_name = 'albedo') AS al,
  max(param_value_numeric) FILTER (param_name = 'rot_per') AS ro FROM phy GROUP BY ALL) h
  ON h.spkid = a.spkid AND h.snapshot_key = a.snapshot_key AND h.run_id = a.run_id"""
_PROFILE_TABLES = ["anc", "brg", "cat", "orb", "elm", "phy"]


@query("catalog_profile", "C14 W10 A5 F10 F11", with_tables(_PROFILE, *_PROFILE_TABLES))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return catalog.catalog_profile(lake.objects, lake.orbits, lake.elements, lake.physical, lake.bridge)


@query("threat_watchlist_view", "C7 J5 J7 A6 A12 W2 F9", with_tables("""
SELECT n.closest_approach_date, n.id AS neows_id, n.name AS neo_name, n.miss_distance_km, n.miss_distance_km / 384400.0::DOUBLE AS miss_distance_lunar,
  n.hazardous AS is_neo_hazardous, b.ky AS asteroid_key, coalesce(s.n, 0) > 0 AS is_sentry_monitored, coalesce(s.n, 0) > 1 AS is_sentry_ambiguous,
  coalesce(s.n, 0) AS sentry_identifier_count, s.sid AS sentry_id, s.ip AS sentry_impact_probability, s.pm AS sentry_palermo_scale_max,
  s.tm AS sentry_torino_scale_max, s.pc AS sentry_potential_impacts_count, s.yr AS sentry_impact_year_range, s.act AS sentry_is_currently_active,
  s.aip AS sentry_all_time_max_impact_probability, s.apm AS sentry_all_time_max_palermo_scale_max, s.atm AS sentry_all_time_max_torino_scale_max,
  c.spkid AS sbdb_spkid, c.designation AS sbdb_designation, c.fullname AS sbdb_fullname, c.orbit_class_name AS sbdb_orbit_class_name,
  c.is_pha AS sbdb_is_pha, c.earth_moid_au AS sbdb_earth_moid_au, c.condition_code AS sbdb_condition_code, c.data_arc_days AS sbdb_data_arc_days,
  c.n_obs_used AS sbdb_n_obs_used, coalesce(c.astrometric_data_quality_tier, 'UNREPORTED') AS sbdb_astrometric_quality_tier
FROM (SELECT * FROM apr QUALIFY row_number() OVER (PARTITION BY id, closest_approach_date
  ORDER BY year DESC, month DESC, day DESC, name DESC NULLS LAST, miss_distance_km DESC, hazardous DESC NULLS LAST) = 1) n
LEFT JOIN (SELECT identifier_value AS id, max(asteroid_key) AS ky FROM brg WHERE source_system = 'neows' AND identifier_name = 'id' GROUP BY 1) b ON b.id = n.id
LEFT JOIN rbe s ON s.asteroid_key = b.ky LEFT JOIN pvt p ON p.asteroid_key = b.ky LEFT JOIN chp c ON c.spkid = p.spkid""", "apr", "brg", "rbe", "pvt", "chp"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return watchlist.threat_watchlist_view(
        lake.asteroids, lake.risk, lake.objects, lake.orbits, lake.elements, lake.physical, lake.bridge, D.AS_OF)


def _watchlist(spark, sf):
    lake = D.lakehouse(spark, sf)
    return watchlist.threat_watchlist(lake.asteroids, lake.risk, lake.objects, lake.bridge, lake.audit)


@query("threat_watchlist", "C11 J6 W2 A6 F18", with_tables("SELECT * FROM wls", "wls"))
def _(spark, sf):
    return _watchlist(spark, sf)


@query("watchlist_filtered_page", "P11 T2 T3", with_tables("""
SELECT * FROM wls WHERE NOT hazardous AND is_sentry_monitored AND miss_distance_km <= 30.5 * 1e6
ORDER BY miss_distance_km, closest_approach_date, neows_id LIMIT 40 OFFSET 10""", "wls"))
def _(spark, sf):
    return watchlist.watchlist_page(_watchlist(spark, sf), 40, 10, hazardous=False, sentry_monitored=True, horizon_mkm=30.5)[0]


@query("watchlist_page_figures", "T3", with_tables("""
SELECT count(*) AS total, 40 AS "limit", 10 AS "offset", greatest(0, least(40, count(*) - 10)) AS returned FROM wls
WHERE hazardous AND is_sentry_monitored AND miss_distance_km <= 30.5 * 1e6""", "wls"))
def _(spark, sf):
    return watchlist.watchlist_page(_watchlist(spark, sf), 40, 10, hazardous=True, sentry_monitored=True, horizon_mkm=30.5)[1]


@query("id_resolution", "C10 J9 W4 F18", with_tables("SELECT * EXCLUDE (evidence_json) FROM res", "res"))
def _(spark, sf):
    bridge, audit = D.published_crosswalk(spark, sf)
    ids = D.approaches(spark, sf).select(F.col("id").alias("neows_id")).distinct()
    return watchlist.resolve_ids(ids, audit, bridge)


@query("cross_source_profile", "C8 A10 A13 J10 A6", with_tables("""
SELECT e.asteroid_key, p.spkid AS canonical_spkid, c.designation AS canonical_designation, c.fullname AS canonical_fullname,
  n.c IS NOT NULL AS has_neows_telemetry, c.spkid IS NOT NULL AS has_sbdb_characterization, s.n IS NOT NULL AS has_sentry_monitoring,
  n.c AS neows_total_approaches_recorded, n.d0 AS neows_earliest_approach_date, n.d1 AS neows_latest_approach_date, n.km AS neows_min_miss_distance_km,
  coalesce(n.hz, false) AS is_classified_hazardous_neows, c.orbit_class_name AS sbdb_orbit_class_name, c.is_pha AS sbdb_is_pha,
  c.earth_moid_au AS sbdb_earth_moid_au, c.condition_code AS sbdb_condition_code, c.data_arc_days AS sbdb_data_arc_days,
  c.estimated_diameter_km AS sbdb_estimated_diameter_km, c.absolute_magnitude AS sbdb_absolute_magnitude,
  coalesce(c.astrometric_data_quality_tier, 'UNREPORTED') AS sbdb_astrometric_quality_tier, coalesce(s.n, 0) > 1 AS is_sentry_ambiguous,
  coalesce(s.n, 0) AS sentry_identifier_count, s.sid AS sentry_id, s.act AS sentry_is_currently_active, s.obs AS sentry_total_snapshots_observed,
  s.ip AS sentry_latest_impact_probability, s.aip AS sentry_all_time_max_impact_probability, s.pm AS sentry_latest_palermo_scale_max,
  s.apm AS sentry_all_time_max_palermo_scale_max, s.tm AS sentry_latest_torino_scale_max, s.atm AS sentry_all_time_max_torino_scale_max,
  s.pc AS sentry_potential_impacts_count, s.yr AS sentry_impact_year_range, coalesce(s.crossed, false) AS is_crosswalk_ambiguous
FROM (SELECT DISTINCT asteroid_key FROM brg) e LEFT JOIN pvt p USING (asteroid_key) LEFT JOIN chp c ON c.spkid = p.spkid
LEFT JOIN (SELECT b.asteroid_key, count(DISTINCT a.closest_approach_date || ':' || a.id) AS c, min(a.closest_approach_date) AS d0,
  max(a.closest_approach_date) AS d1, min(a.miss_distance_km) AS km, bool_or(coalesce(a.hazardous, false)) AS hz
  FROM apr a JOIN brg b ON b.source_system = 'neows' AND b.identifier_name = 'id' AND b.identifier_value = a.id GROUP BY 1) n ON n.asteroid_key = e.asteroid_key
LEFT JOIN rbe s ON s.asteroid_key = e.asteroid_key""", "brg", "pvt", "chp", "apr", "rbe"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return cross_source.cross_source_profile(
        lake.asteroids, lake.risk, lake.objects, lake.orbits, lake.elements, lake.physical, lake.bridge, D.AS_OF)


@query("crosswalk_coverage_audit", "C9 W11 J11 A11 J12", with_tables("""
SELECT source_system, match_state, match_rule, count(*) AS evaluation_count, t AS total_source_system_evaluations,
  round(count(*) / t * 100, 4) AS pct_of_source_system, count(DISTINCT assigned_asteroid_key) AS resolved_to_canonical_key_count,
  max(resolution_run_id) AS resolution_run_id, max(resolved_at) AS resolved_at
FROM aud JOIN (SELECT source_system, count(*) AS t FROM aud GROUP BY 1) USING (source_system) GROUP BY 1, 2, 3, t""", "aud"))
def _(spark, sf):
    return cross_source.crosswalk_coverage_audit(D.published_crosswalk(spark, sf)[1])


def _world(spark, sf):
    lake = D.lakehouse(spark, sf)
    return world.world_snapshot(lake.asteroids, lake.risk, lake.objects, lake.orbits, lake.bridge, lake.audit)


@query("world_snapshot", "C12 W3 W10 J8 J3 U5", with_tables("SELECT * FROM wld", "wld"))
def _(spark, sf):
    return _world(spark, sf)


_CAT_STATUS = ("CASE WHEN match_state <> 'RESOLVED' THEN 'not_resolved' WHEN sbdb_spkid IS NULL OR sbdb_snapshot_key IS NULL "
               "THEN 'not_present' ELSE 'available' END")
_RISK_STATUS = ("CASE WHEN match_state <> 'RESOLVED' THEN 'not_resolved' WHEN sentry_link_count = 0 THEN 'not_present' "
                "WHEN sentry_link_count > 1 THEN 'ambiguous' WHEN sentry_snapshot_key IS NULL THEN 'linked_no_record' ELSE 'available' END")
_U = "('0x' || substr(sha256('{}' || neows_id), {}, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE"
_Z = f"(1 - 2 * {_U.format(V.DIRECTION_SALT, 1)})"
_PHI = f"(2 * pi() * {_U.format(V.DIRECTION_SALT, 17)})"


@query("world_records", "C12 F19 F20 F24 F31", with_tables(f"""
SELECT neows_id, name, CASE WHEN match_state = 'RESOLVED' THEN asteroid_key END AS asteroid_key, hazardous AS is_potentially_hazardous,
  {_CAT_STATUS} AS sbdb_status, CASE WHEN {_CAT_STATUS} = 'available' THEN sbdb_run_id END AS sbdb_run_id,
  {_RISK_STATUS} AS sentry_status, CASE WHEN {_RISK_STATUS} = 'available' THEN sentry_snapshot_key = sentry_latest_catalog_snapshot_key END AS in_latest_catalog,
  round(sqrt(greatest(0, 1 - {_Z} * {_Z})) * cos({_PHI}), 9) AS x, round(sqrt(greatest(0, 1 - {_Z} * {_Z})) * sin({_PHI}), 9) AS y, round({_Z}, 9) AS z
FROM wld""", "wld"))
def _(spark, sf):
    rec = world.world_records(_world(spark, sf))
    axis = lambda c: F.round(f"illustrative_direction.{c}", 9).alias(c)
    return rec.select(
        "neows_id", "name", "asteroid_key", F.col("encounter.is_potentially_hazardous").alias("is_potentially_hazardous"),
        F.col("sbdb.status").alias("sbdb_status"), F.col("sbdb.run_id").alias("sbdb_run_id"),
        F.col("sentry.status").alias("sentry_status"), F.col("sentry.in_latest_catalog").alias("in_latest_catalog"),
        axis("x"), axis("y"), axis("z"))


def _lineage(spark, sf):
    """The run table of the approach dataset: a run per year, the newest one is served."""
    runs = D.table(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("y"), "o_orderkey").groupBy("y").agg(F.max("o_orderkey").alias("top"))
    runs = runs.select(
        F.lit("asteroids").alias("table_name"), F.concat(F.lit("run-"), "y").alias("run_id"), F.concat("y", F.lit("-12-31")).alias("ingested_at"),
        F.lit("neows").alias("source"), F.concat(F.lit("raw_"), "y", F.lit(".json")).alias("source_raw_file"), F.sha2(F.col("top").cast("string"), 256).alias("source_raw_sha256"))
    return dataset_lineage(runs)


_LINEAGE = """(SELECT 'run-' || max(year(o_orderdate)) AS run_id, 'raw_' || max(year(o_orderdate)) || '.json' AS raw_file,
  sha256((max(o_orderkey) FILTER (year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)))::VARCHAR) AS raw_sha FROM orders)"""


@query("world_info", "C12 P15 F33", with_tables(f"""
SELECT count(*) AS object_count, 'CLOSEST_OBSERVED_APPROACH' AS encounter_selection_rule,
  max(sentry_latest_catalog_snapshot_key) AS sentry_latest_catalog_snapshot_key, '{",".join(_OPTIONAL)}' AS neows_fields_not_in_dataset,
  '{V.DIRECTION_ALGORITHM}' AS direction_algorithm, any_value(run_id) AS dataset_run_id, any_value(raw_file) AS source_raw_file,
  any_value(raw_sha) AS source_raw_sha256 FROM wld, {_LINEAGE}""", "wld"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    old = lake.asteroids.drop(*_OPTIONAL)  # a dataset from before the optional columns
    _, missing = world.with_optional_columns(old)
    flat = world.world_snapshot(old, lake.risk, lake.objects, lake.orbits, lake.bridge, lake.audit)
    info = as_text(world.world_info(flat, missing, _lineage(spark, sf)), "neows_fields_not_in_dataset")
    return info.select("*", F.col("spatial_model.direction_algorithm").alias("direction_algorithm"), "neows.*").drop("spatial_model", "neows")


_RISK_PROFILE = """
SELECT e.asteroid_key, coalesce(l.n, 0) > 0 AS has_sentry_monitoring, coalesce(l.n, 0) > 1 AS is_sentry_ambiguous, coalesce(l.n, 0) AS sentry_identifier_count,
  CASE WHEN l.n = 1 THEN l.sid END AS sentry_id, r.designation, r.fullname, r.impact_probability AS latest_impact_probability,
  r.palermo_scale_max AS latest_palermo_scale_max, r.palermo_scale_cum AS latest_palermo_scale_cum, r.torino_scale_max AS latest_torino_scale_max,
  r.potential_impacts_count AS latest_potential_impacts_count, r.v_infinity_km_s, r.impact_year_range, r.last_obs_date,
  r.snapshot_key AS latest_snapshot_key, coalesce(t.n, 0) AS total_snapshots_observed, t.a AS all_time_max_impact_probability,
  t.b AS all_time_max_palermo_scale_max, t.c AS all_time_max_torino_scale_max,
  coalesce(r.snapshot_key = (SELECT max(snapshot_key) FROM rsk), false) AS is_currently_active
FROM (SELECT DISTINCT asteroid_key FROM brg) e LEFT JOIN lnk l USING (asteroid_key) LEFT JOIN lrk r ON l.n = 1 AND r.sentry_id = l.sid
LEFT JOIN (SELECT sentry_id, count(DISTINCT snapshot_key) AS n, max(impact_probability) AS a, max(palermo_scale_max) AS b, max(torino_scale_max) AS c
  FROM rsk GROUP BY 1) t ON t.sentry_id = r.sentry_id"""


@query("risk_profile", "C15 U5 A15 W1", with_tables(_RISK_PROFILE, "brg", "lnk", "lrk", "rsk"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return dossier.risk_profile(lake.risk, lake.bridge)


@query("crosswalk_listing", "C17 T5", with_tables("SELECT * FROM brg", "brg"))
def _(spark, sf):
    return dossier.crosswalk(D.published_crosswalk(spark, sf)[0])


@query("asteroid_detail", "C18 W3", with_tables("""
SELECT neows_id, name, closest_approach_date, miss_distance_km, miss_distance_lunar, hazardous, c AS approaches_recorded_count,
  'CLOSEST_OBSERVED_APPROACH' AS selection_rule, asteroid_key, match_state, is_sentry_monitored, is_sentry_ambiguous, sentry_id,
  has_sbdb_characterization, sbdb_spkid, sbdb_designation, sbdb_fullname, sbdb_orbit_class_name
FROM (SELECT *, count(*) OVER (PARTITION BY neows_id) AS c FROM wls)
QUALIFY row_number() OVER (PARTITION BY neows_id ORDER BY miss_distance_km, closest_approach_date) = 1""", "wls"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return dossier.asteroid_detail(lake.asteroids, lake.risk, lake.objects, lake.bridge, lake.audit)


_EVIDENCE = """CASE WHEN NOT regexp_full_match(s.neows_id, '[0-9]+') THEN 'NeoWs identifier must contain only numeric digits.'
  ELSE coalesce(s.evidence_json, 'No crosswalk record found for this NeoWs identifier.') END"""


_ANSWERED = [*catalog.OBJECT_FIELDS, "snapshot_key", "run_id", "snapshot_time", "orbit_id", "epoch_jd", "equinox",
             *[c for c in catalog.ORBIT_FIELDS if c not in ("epoch_jd", "equinox")], *catalog.PROFILE_ELEMENTS, *catalog.PHYSICAL_PARAMETERS, "astrometric_data_quality_tier"]


@query("catalog_answers", "C19 C14", with_tables(f"""
SELECT s.neows_id, s.match_state, {_EVIDENCE} AS evidence, p.spkid, p.asteroid_key AS answer_key, {", ".join(f"p.{c}" for c in _ANSWERED)}
FROM res s LEFT JOIN ({_PROFILE}) p ON s.match_state = 'RESOLVED' AND p.asteroid_key = s.asteroid_key""", "res", *_PROFILE_TABLES))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    out = dossier.catalog_answers(lake.asteroids, lake.audit, lake.bridge, lake.objects, lake.orbits, lake.elements, lake.physical)
    return out.select("neows_id", "match_state", "evidence", "data.spkid", F.col("data.asteroid_key").alias("answer_key"), *[f"data.{c}" for c in _ANSWERED])


@query("risk_answers", "C19 C15", with_tables(f"""
SELECT s.neows_id, s.match_state, p.has_sentry_monitoring, p.is_sentry_ambiguous, p.sentry_id, p.latest_snapshot_key, p.total_snapshots_observed
FROM res s LEFT JOIN ({_RISK_PROFILE}) p ON s.match_state = 'RESOLVED' AND p.asteroid_key = s.asteroid_key""", "res", "brg", "lnk", "lrk", "rsk"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return dossier.risk_answers(lake.asteroids, lake.audit, lake.bridge, lake.risk).select("neows_id", "match_state", *[
        f"data.{c}" for c in ("has_sentry_monitoring", "is_sentry_ambiguous", "sentry_id", "latest_snapshot_key", "total_snapshots_observed")])


_HISTORY_ANSWERS = f"""
SELECT s.neows_id, s.match_state, s.asteroid_key, s.match_rule, s.resolved_at, {_EVIDENCE} AS evidence, coalesce(l.n > 1, false) AS is_sentry_ambiguous,
  CASE WHEN l.n > 1 THEN '{dossier.AMBIGUITY_NOTE}' END AS warning, CASE WHEN l.n = 1 THEN l.sid END AS sentry_id,
  CASE WHEN l.n = 1 THEN (SELECT count(DISTINCT snapshot_key) FROM rsk WHERE rsk.sentry_id = l.sid) END AS snapshots
FROM res s LEFT JOIN lnk l ON s.match_state = 'RESOLVED' AND l.asteroid_key = s.asteroid_key"""


def _history_answers(spark, sf):
    lake = D.lakehouse(spark, sf)
    return dossier.history_answers(lake.asteroids, lake.audit, lake.bridge, lake.risk), lake


@query("history_answers", "C19 C16", with_tables(_HISTORY_ANSWERS, "res", "lnk", "rsk"))
def _(spark, sf):
    return _history_answers(spark, sf)[0]


@query("history_rows", "C19 C16 W9", with_tables("""
SELECT s.neows_id, r.sentry_id, r.snapshot_key, r.impact_probability, r.palermo_scale_max,
  coalesce(r.impact_probability <> r.prev_ip, false) AS is_impact_probability_changed, coalesce(r.palermo_scale_max <> r.prev_ps, false) AS is_palermo_scale_max_changed
FROM res s JOIN lnk l ON s.match_state = 'RESOLVED' AND l.asteroid_key = s.asteroid_key AND l.n = 1
JOIN (SELECT *, lag(impact_probability) OVER w AS prev_ip, lag(palermo_scale_max) OVER w AS prev_ps FROM rsk WINDOW w AS (PARTITION BY sentry_id ORDER BY snapshot_key)) r
  ON r.sentry_id = l.sid""", "res", "lnk", "rsk"))
def _(spark, sf):
    answers, lake = _history_answers(spark, sf)
    return dossier.history_rows(answers, lake.risk).select(
        "neows_id", "sentry_id", "snapshot_key", "impact_probability", "palermo_scale_max", "is_impact_probability_changed", "is_palermo_scale_max_changed")


@query("crosswalk_answers", "C19 C17", with_tables("""
SELECT s.neows_id, s.match_state, b.source_system, b.identifier_name, b.identifier_value, b.is_primary_pivot
FROM res s LEFT JOIN brg b ON s.match_state = 'RESOLVED' AND b.asteroid_key = s.asteroid_key""", "res", "brg"))
def _(spark, sf):
    lake = D.lakehouse(spark, sf)
    return dossier.crosswalk_answers(lake.asteroids, lake.audit, lake.bridge).select(
        "neows_id", "match_state", "source_system", "identifier_name", "identifier_value", "is_primary_pivot")


def _missing(fields: dict[str, str]) -> str:
    """`field=reason` text of the NULL fields, in order."""
    parts = ", ".join(f"CASE WHEN {expr} IS NULL THEN '{f}=' || {why} END" for f, (expr, why) in fields.items())
    return f"concat_ws(',', {parts})"


_NO_CAT = "CASE WHEN match_state <> 'RESOLVED' THEN 'not_resolved' ELSE 'not_in_source' END"
_IDENTITY = {
    "asteroid_key": ("CASE WHEN match_state = 'RESOLVED' THEN asteroid_key END", _NO_CAT),
    "sbdb_spkid": ("CASE WHEN match_state = 'RESOLVED' THEN sbdb_spkid END", _NO_CAT),
    "sbdb_designation": ("cd", _NO_CAT), "sbdb_fullname": ("cf", _NO_CAT),
    "sentry_id": ("CASE WHEN rs IN ('available', 'linked_no_record') THEN sentry_id END",
                  f"CASE WHEN rs = 'ambiguous' THEN 'ambiguous_linkage' ELSE {_NO_CAT} END"),
}
_ENCOUNTER = {c: (e, "'not_in_source'") for c, e in (
    ("is_potentially_hazardous", "hazardous"), ("close_approach_datetime", "close_approach_datetime"),
    ("close_approach_epoch_ms", "close_approach_epoch_ms"), ("relative_velocity_km_s", "relative_velocity_km_s"),
    ("is_sentry_object", "is_sentry_object"))}
_ORBIT_WHY = {c: (f"p.{c}", "why") for c in dossier.ORBIT_SECTION}
_BODY = {c: (f"p.{c}", "why") for c in dossier.PHYSICAL_SECTION}
_ASSESS = {c: (f"CASE WHEN rs = 'available' THEN nullif(sentry_{c}::VARCHAR, '') END",
               "CASE rs WHEN 'not_resolved' THEN 'not_resolved' WHEN 'ambiguous' THEN 'ambiguous_linkage' ELSE 'not_in_source' END")
           for c in _RISK_ASSESSMENT}


def _status(text: str, n: int) -> str:
    return f"CASE WHEN {text} = '' THEN 'available' WHEN len(string_split({text}, ',')) = {n} THEN 'unavailable' ELSE 'partial' END"


_PROFILE_SQL = f"""
SELECT neows_id, {_missing(_IDENTITY)} AS identity_missing, {_status(_missing(_IDENTITY), 5)} AS identity_status,
  {_missing(_ENCOUNTER)} AS encounter_missing, {_status(_missing(_ENCOUNTER), 5)} AS encounter_status,
  {_missing(_ORBIT_WHY)} AS orbit_missing, {_status(_missing(_ORBIT_WHY), 28)} AS orbit_status,
  {_missing(_BODY)} AS physical_missing, {_missing(_ASSESS)} AS assessment_missing, {_status(_missing(_ASSESS), 13)} AS assessment_status,
  rs AS sentry_status, CASE WHEN rs IN ('available', 'linked_no_record') THEN '/asteroids/' || neows_id || '/sentry' END AS assessment_endpoint,
  p.snapshot_key AS catalog_snapshot_key, CASE WHEN rs = 'available' THEN sentry_snapshot_time END AS risk_snapshot_time,
  l.run_id AS dataset_run_id, l.raw_sha AS source_raw_sha256
FROM {_LINEAGE} l, (SELECT w.*, {_RISK_STATUS} AS rs, q.designation AS cd, q.fullname AS cf, q AS p, {_NO_CAT} AS why FROM wld w
LEFT JOIN ({_PROFILE}) q ON w.match_state = 'RESOLVED' AND w.sbdb_snapshot_key IS NOT NULL AND q.asteroid_key = w.asteroid_key)"""


def _profile(spark, sf):
    lake = D.lakehouse(spark, sf)
    return dossier.unified_profile(
        lake.asteroids, lake.risk, lake.objects, lake.orbits, lake.elements, lake.physical, lake.bridge, lake.audit, lineage=_lineage(spark, sf))


def _map_text(column: str):
    return F.array_join(F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


# Overridden reasons move to the end of their map, so the identity entries are put in field order.
_IDENTITY_ORDER = ["asteroid_key", "sbdb_spkid", "sbdb_designation", "sbdb_fullname", "sentry_id"]


@query("unified_profile", "C20 F21 F22 F23 F29", with_tables(_PROFILE_SQL, "wld", *_PROFILE_TABLES))
def _(spark, sf):
    p = _profile(spark, sf)
    ident = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col("identity.availability.unavailable")[c]) for c in _IDENTITY_ORDER])
    return p.select(
        "neows_id", ident.alias("identity_missing"), F.col("identity.availability.status").alias("identity_status"),
        _map_text("encounter.availability.unavailable").alias("encounter_missing"),
        F.col("encounter.availability.status").alias("encounter_status"),
        _map_text("orbit.availability.unavailable").alias("orbit_missing"), F.col("orbit.availability.status").alias("orbit_status"),
        _map_text("physical.availability.unavailable").alias("physical_missing"),
        _map_text("sentry.assessment.availability.unavailable").alias("assessment_missing"),
        F.col("sentry.assessment.availability.status").alias("assessment_status"),
        F.col("sentry.status").alias("sentry_status"), F.col("sentry.assessment_endpoint").alias("assessment_endpoint"),
        F.col("provenance.sbdb.snapshot_key").alias("catalog_snapshot_key"),
        F.col("provenance.sentry.snapshot_time").alias("risk_snapshot_time"),
        F.col("provenance.neows.dataset_run_id").alias("dataset_run_id"), F.col("provenance.neows.source_raw_sha256").alias("source_raw_sha256"))


@query("dominant_missing_reason", "A17", with_tables(f"""
SELECT neows_id, CASE WHEN a <> '' THEN CASE rs WHEN 'not_resolved' THEN 'not_resolved' WHEN 'ambiguous' THEN 'ambiguous_linkage' ELSE 'not_in_source' END END
  AS assessment_reason, CASE WHEN e <> '' THEN 'not_in_source' END AS encounter_reason
FROM (SELECT neows_id, rs, {_missing(_ASSESS)} AS a, {_missing(_ENCOUNTER)} AS e FROM (SELECT *, {_RISK_STATUS} AS rs FROM wld))""", "wld"))
def _(spark, sf):
    return _profile(spark, sf).select(
        "neows_id", dominant_reason(F.col("sentry.assessment.availability.unavailable")).alias("assessment_reason"),
        dominant_reason(F.col("encounter.availability.unavailable")).alias("encounter_reason"))


_ORBIT_VALUES = [c for c in dossier.ORBIT_SECTION if c not in ("is_neo", "is_pha")]


@query("unified_profile_values", "C20 C14 P2 F29", with_tables(f"""
SELECT neows_id, name, closest_approach_date, miss_distance_km, hazardous AS is_potentially_hazardous, close_approach_datetime, close_approach_epoch_ms,
  relative_velocity_km_s, is_sentry_object, absolute_magnitude_h, estimated_diameter_min_km, estimated_diameter_max_km,
  p.is_neo AS is_neo, p.is_pha AS is_pha, {", ".join(f"p.{c} AS {c}" for c in _ORBIT_VALUES)},
  {", ".join(f"p.{c} AS {c}" for c in dossier.PHYSICAL_SECTION)},
  {", ".join(f"CASE WHEN rs = 'available' THEN " + (f"nullif(sentry_{c}, '')" if c in ("designation", "fullname", "impact_year_range", "last_obs_date") else f"sentry_{c}") + f" END AS sentry_{c}" for c in _RISK_ASSESSMENT)}
FROM (SELECT w.*, {_RISK_STATUS} AS rs, q AS p FROM wld w
LEFT JOIN ({_PROFILE}) q ON w.match_state = 'RESOLVED' AND w.sbdb_snapshot_key IS NOT NULL AND q.asteroid_key = w.asteroid_key)""", "wld", *_PROFILE_TABLES))
def _(spark, sf):
    p = _profile(spark, sf)
    section = lambda name, fields, prefix="": [F.col(f"{name}.{c}").alias(f"{prefix}{c}") for c in fields]
    return p.select(
        "neows_id", F.col("identity.name").alias("name"),
        *section("encounter", ["closest_approach_date", "miss_distance_km", "is_potentially_hazardous", "close_approach_datetime", "close_approach_epoch_ms", "relative_velocity_km_s", "is_sentry_object"]),
        *section("neows_physical", dossier.APPROACH_PHYSICAL_SECTION), *section("orbit", ["is_neo", "is_pha", *_ORBIT_VALUES]),
        *section("physical", dossier.PHYSICAL_SECTION), *section("sentry.assessment", _RISK_ASSESSMENT, "sentry_"))


# --- several resolution runs ---------------------------------------------------------------------

_LAST = "right(source_identifier_value, 1)"
_LOG = f"""(SELECT resolution_run_id, resolved_at, source_system, identifier_name, source_identifier_value, match_state, match_rule, assigned_asteroid_key, evidence_json
  FROM aud WHERE NOT (source_system = 'neows' AND {_LAST} = '9')
UNION ALL SELECT 'run-0002', CASE WHEN {_LAST} IN ('1', '2') THEN resolved_at ELSE '2024-03-02T00:00:00Z' END, source_system, identifier_name, source_identifier_value,
  CASE WHEN {_LAST} = '0' THEN 'UNRESOLVED' ELSE match_state END, CASE WHEN {_LAST} = '0' THEN 'SECOND_RUN' ELSE match_rule END,
  CASE WHEN {_LAST} <> '0' THEN assigned_asteroid_key END, evidence_json FROM aud WHERE {_LAST} IN ('0', '1', '2', '3', '4')
UNION ALL SELECT 'run-0003', '2024-03-02T00:00:00Z', source_system, identifier_name, source_identifier_value, match_state, 'THIRD_RUN', assigned_asteroid_key, evidence_json
  FROM aud WHERE {_LAST} IN ('3', '5'))"""
_DOUBLED = """(SELECT asteroid_key, source_system, identifier_name, identifier_value FROM brg UNION ALL
  SELECT 'other-' || identifier_value, source_system, identifier_name, identifier_value FROM brg WHERE source_system = 'neows' AND right(identifier_value, 2) IN ('19', '39', '59', '79', '99'))"""


def _audit_log(spark, sf):
    """Three runs over the stored audit, whose clocks overlap: the second takes up a half of the identifiers,
    the third two tenths, and no run has evaluated approach ids that end in 9."""
    audit = D.published_crosswalk(spark, sf)[1]
    last, late = F.expr("right(source_identifier_value, 1)"), F.lit("2024-03-02T00:00:00Z")
    first = audit.filter(~((F.col("source_system") == V.APPROACH_FEED) & (last == "9")))
    second = audit.filter(last.isin("0", "1", "2", "3", "4")).withColumns({
        "resolution_run_id": F.lit("run-0002"), "resolved_at": F.when(last.isin("1", "2"), F.col("resolved_at")).otherwise(late),
        "match_state": F.when(last == "0", V.UNRESOLVED).otherwise(F.col("match_state")), "match_rule": F.when(last == "0", "SECOND_RUN").otherwise(F.col("match_rule")),
        "assigned_asteroid_key": F.when(last != "0", F.col("assigned_asteroid_key"))})
    third = audit.filter(last.isin("3", "5")).withColumns({"resolution_run_id": F.lit("run-0003"), "resolved_at": late, "match_rule": F.lit("THIRD_RUN")})
    folder = fresh_path(spark, "audit-log")
    for rows in (first, second, third):
        append_run(rows, folder)
    return folder


@query("coverage_of_latest_run", "C9 W11 J11 A11 J12", with_tables(f"""
SELECT source_system, match_state, match_rule, count(*) AS evaluation_count, t AS total_source_system_evaluations, round(count(*) / t * 100, 4) AS pct_of_source_system,
  count(DISTINCT assigned_asteroid_key) AS resolved_to_canonical_key_count, max(resolution_run_id) AS resolution_run_id, max(resolved_at) AS resolved_at
FROM (SELECT *, count(*) OVER (PARTITION BY source_system) AS t FROM {_LOG} WHERE resolution_run_id = (SELECT resolution_run_id FROM {_LOG} ORDER BY resolved_at DESC, resolution_run_id DESC LIMIT 1))
GROUP BY 1, 2, 3, t""", "aud"))
def _(spark, sf):
    return cross_source.crosswalk_coverage_audit(read_latest_run(spark, _audit_log(spark, sf)))


@query("id_resolution_over_runs", "W4 C10 J9 F18 A12", with_tables(f"""
SELECT i.id AS neows_id,
  CASE WHEN NOT regexp_full_match(i.id, '[0-9]+') THEN 'INVALID' WHEN a.match_state = 'RESOLVED' AND a.assigned_asteroid_key IS NULL THEN 'UNRESOLVED'
    WHEN a.match_state IS NOT NULL THEN a.match_state WHEN b.n = 1 THEN 'RESOLVED' WHEN b.n > 1 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS match_state,
  CASE WHEN NOT regexp_full_match(i.id, '[0-9]+') THEN NULL WHEN a.match_state = 'RESOLVED' THEN a.assigned_asteroid_key WHEN a.match_state IS NULL AND b.n = 1 THEN b.ky END AS asteroid_key,
  CASE WHEN NOT regexp_full_match(i.id, '[0-9]+') THEN 'INVALID_SYNTAX' WHEN a.match_state IS NOT NULL THEN coalesce(a.match_rule, 'NO_CROSS_SOURCE_MATCH')
    WHEN b.n = 1 THEN 'BRIDGE_EXACT_NEOWS_ID' WHEN b.n > 1 THEN 'BRIDGE_MULTIPLE_CANDIDATE_KEYS' ELSE 'NO_RESOLUTION_RECORD' END AS match_rule, a.resolved_at
FROM (SELECT DISTINCT id FROM apr) i
LEFT JOIN (SELECT * FROM {_LOG} WHERE source_system = 'neows' AND identifier_name = 'id'
  QUALIFY row_number() OVER (PARTITION BY source_identifier_value ORDER BY resolved_at DESC, resolution_run_id DESC) = 1) a ON a.source_identifier_value = i.id
LEFT JOIN (SELECT identifier_value AS id, count(DISTINCT asteroid_key) AS n, min(asteroid_key) AS ky FROM {_DOUBLED}
  WHERE source_system = 'neows' AND identifier_name = 'id' GROUP BY 1) b ON b.id = i.id""", "apr", "aud", "brg"))
def _(spark, sf):
    bridge = D.published_crosswalk(spark, sf)[0]
    twice = bridge.filter((F.col("source_system") == V.APPROACH_FEED) & F.expr("right(identifier_value, 2) IN ('19', '39', '59', '79', '99')"))
    bridge = bridge.unionByName(twice.withColumn("asteroid_key", F.concat(F.lit("other-"), "identifier_value")))
    ids = D.approaches(spark, sf).select(F.col("id").alias("neows_id")).distinct()
    return watchlist.resolve_ids(ids, read_runs(spark, _audit_log(spark, sf)), bridge)


@query("risk_of_several_keys", "J2 A6 C3", with_tables("""
SELECT r.snapshot_key, r.sentry_id, b.asteroid_key, lag(r.impact_probability) OVER (PARTITION BY r.sentry_id ORDER BY r.snapshot_key, r.snapshot_time, r.run_id, b.asteroid_key) AS prev_impact_probability
FROM rsk r JOIN cov USING (snapshot_key) LEFT JOIN (SELECT identifier_value, asteroid_key FROM brg WHERE source_system = 'sentry' AND identifier_name = 'sentry_id'
  UNION SELECT identifier_value, 'zz-' || identifier_value FROM brg WHERE source_system = 'sentry' AND identifier_name = 'sentry_id' AND identifier_value LIKE '%7') b ON b.identifier_value = r.sentry_id""", "rsk", "cov", "brg"))
def _(spark, sf):
    bridge = D.published_crosswalk(spark, sf)[0]
    twice = bridge.filter((F.col("source_system") == V.RISK_FEED) & (F.col("identifier_name") == "sentry_id") & F.col("identifier_value").endswith("7"))
    bridge = bridge.unionByName(twice.withColumn("asteroid_key", F.concat(F.lit("zz-"), "identifier_value")))
    rows = risk_metric_history(D.risk_snapshots(spark, sf), bridge)
    return rows.select("snapshot_key", "sentry_id", "asteroid_key", "prev_impact_probability")


# --- datasets of another shape -------------------------------------------------------------------

@query("approaches_stored_twice", "W2", with_tables("""
SELECT id, name, closest_approach_date, miss_distance_km, hazardous, year, month, day FROM (
SELECT id, name, closest_approach_date, miss_distance_km, hazardous, year, month, day FROM apr
UNION ALL SELECT id, name, closest_approach_date, miss_distance_km * 2, hazardous, (year::INT + 1)::VARCHAR, month, day FROM apr WHERE hazardous
UNION ALL SELECT id, 'older', closest_approach_date, 1.0, true, (year::INT - 1)::VARCHAR, month, day FROM apr)
QUALIFY row_number() OVER (PARTITION BY id, closest_approach_date ORDER BY year DESC, month DESC, day DESC, name DESC NULLS LAST, miss_distance_km DESC, hazardous DESC NULLS LAST) = 1""", "apr"))
def _(spark, sf):
    """Approaches that lie in the partitions of two or three years."""
    rows = D.approaches(spark, sf).select("id", "name", "closest_approach_date", "miss_distance_km", "hazardous", "year", "month", "day")
    shifted = lambda n: (F.col("year").cast("int") + n).cast("string")
    again = rows.filter("hazardous").withColumns({"miss_distance_km": F.col("miss_distance_km") * 2, "year": shifted(1)})
    older = rows.withColumns({"name": F.lit("older"), "miss_distance_km": F.lit(1.0), "hazardous": F.lit(True), "year": shifted(-1)})
    return newest_partition(rows.unionByName(again).unionByName(older))


_OLDER = ["relative_velocity_km_s", "estimated_diameter_max_km", "is_sentry_object"]


@query("profile_of_older_dataset", "F22 F21 P15 C20", with_tables("""
SELECT neows_id, 'not_in_current_contract' AS relative_velocity_km_s, 'not_in_current_contract' AS estimated_diameter_max_km, 'not_in_current_contract' AS is_sentry_object,
  CASE WHEN close_approach_datetime IS NULL THEN 'not_in_source' END AS close_approach_datetime, CASE WHEN hazardous IS NULL THEN 'not_in_source' END AS is_potentially_hazardous,
  CASE WHEN estimated_diameter_min_km IS NULL THEN 'not_in_source' END AS estimated_diameter_min_km, 'partial' AS encounter_status
FROM wld""", "wld"))
def _(spark, sf):
    """Profiles over an approach table from before three of its columns."""
    lake = D.lakehouse(spark, sf)
    p = dossier.unified_profile(
        lake.asteroids.drop(*_OLDER), lake.risk, lake.objects, lake.orbits, lake.elements, lake.physical, lake.bridge, lake.audit)
    why = lambda section, name: F.col(f"{section}.availability.unavailable")[name].alias(name)
    return p.select(
        "neows_id", why("encounter", "relative_velocity_km_s"), why("neows_physical", "estimated_diameter_max_km"), why("encounter", "is_sentry_object"),
        why("encounter", "close_approach_datetime"), why("encounter", "is_potentially_hazardous"), why("neows_physical", "estimated_diameter_min_km"),
        F.col("encounter.availability.status").alias("encounter_status"))
