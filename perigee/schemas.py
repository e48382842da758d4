"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

LINEAGE = "snapshot_key string, run_id string, snapshot_time string"
DATE_PARTS = "year string, month string, day string"

OPTIONAL_APPROACH_COLUMNS = {
    "close_approach_datetime": "string",
    "close_approach_epoch_ms": "bigint",
    "relative_velocity_km_s": "double",
    "absolute_magnitude_h": "double",
    "estimated_diameter_min_km": "double",
    "estimated_diameter_max_km": "double",
    "is_sentry_object": "boolean",
}

APPROACH_CORE = "id string, name string, closest_approach_date string, miss_distance_km double, hazardous boolean"

RISK_ASSESSMENT_COLUMNS = {
    "designation": "string",
    "fullname": "string",
    "absolute_magnitude": "double",
    "estimated_diameter_km": "double",
    "impact_probability": "double",
    "potential_impacts_count": "bigint",
    "palermo_scale_cum": "double",
    "palermo_scale_max": "double",
    "torino_scale_max": "bigint",
    "v_infinity_km_s": "double",
    "impact_year_range": "string",
    "last_obs_date": "string",
    "last_obs_jd": "double",
}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


TABLE_DDL = {
    "asteroids": f"{APPROACH_CORE}, {_ddl(OPTIONAL_APPROACH_COLUMNS)}",
    "asteroids_csv": APPROACH_CORE,
    "fact_sentry_risk_snapshot": f"{LINEAGE}, sentry_id string, {_ddl(RISK_ASSESSMENT_COLUMNS)}",
    "fact_sbdb_object_snapshot": (
        f"{LINEAGE}, spkid string, designation string, fullname string, shortname string, object_kind string, "
        "is_neo boolean, is_pha boolean, orbit_class_code string, orbit_class_name string, orbit_id string, "
        "prefix string, alternate_designations array<string>"
    ),
    "fact_sbdb_orbit": (
        f"{LINEAGE}, spkid string, orbit_id string, epoch_jd double, equinox string, soln_date string, "
        "orbit_source string, producer string, first_obs string, last_obs string, data_arc_days bigint, "
        "n_obs_used bigint, condition_code string, rms double, earth_moid_au double, jupiter_moid_au double, "
        "t_jup double, pe_used string, sb_used string"
    ),
    "fact_sbdb_orbit_element": (
        f"{LINEAGE}, spkid string, orbit_id string, epoch_jd double, equinox string, element_name string, "
        "element_value double, sigma double, units string, title string, label string"
    ),
    "fact_sbdb_physical_parameter": (
        f"{LINEAGE}, spkid string, param_name string, param_value_numeric double, param_value_raw string, "
        "sigma double, units string, bib_reference string, notes string, title string, desc string"
    ),
    "bridge_asteroid_identifier": (
        "asteroid_key string, source_system string, identifier_name string, identifier_value string, "
        "is_primary_pivot boolean, created_at string, updated_at string"
    ),
    "fact_entity_resolution": (
        "resolution_run_id string, resolved_at string, source_system string, identifier_name string, "
        "source_identifier_value string, matched_target_system string, matched_target_identifier_name string, "
        "matched_target_identifier_value string, assigned_asteroid_key string, match_state string, "
        "match_rule string, evidence_json string"
    ),
    "relational_asteroids": "asteroid_id string, name string, hazardous boolean",
    "relational_close_approaches": (
        "approach_id string, asteroid_id string, approach_date string, miss_distance_km double"
    ),
}

CATALOG_TABLES = [
    "fact_sbdb_object_snapshot", "fact_sbdb_orbit", "fact_sbdb_orbit_element", "fact_sbdb_physical_parameter",
]
REQUIRED_TABLES = [
    "asteroids", "bridge_asteroid_identifier", "fact_sentry_risk_snapshot", "fact_sbdb_object_snapshot",
]

CHECK_DDL = "check_name string, dataset string, status string, diagnostic string, metrics map<string,string>"


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLE_DDL[name])


def table_columns(name: str) -> list[str]:
    return table_schema(name).fieldNames()
