"""Approaches joined with identity, risk and catalog: bulk resolution and the two watchlists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.functions.orbit import lunar_distances
from perigee.operators.picking import first_by, latest_by, newest_partition
from perigee.operators.tallying import keys_per_identifier, page
from perigee.plans.catalog import characterization_profile, pivot_spkids
from perigee.plans.risk_history import risk_by_entity
from perigee.runtime import attach

WATCHLIST_ORDER = ["miss_distance_km", "closest_approach_date", "neows_id"]


def latest_audit(audit: DataFrame) -> DataFrame:
    """The newest audit row per approach id; rules decide between rows of one instant."""
    rows = audit.filter((F.col("source_system") == V.APPROACH_FEED) & (F.col("identifier_name") == "id"))
    newest = latest_by(
        rows.select("source_identifier_value", "resolved_at", "resolution_run_id", "match_state",
                    "assigned_asteroid_key", "match_rule", "evidence_json"),
        ["source_identifier_value"], ["resolved_at", "resolution_run_id"])
    return newest.select(
        F.col("source_identifier_value").alias("audit_id"), F.col("match_state").alias("audit_state"),
        F.col("assigned_asteroid_key").alias("audit_key"), F.col("match_rule").alias("audit_rule"),
        F.col("resolved_at").alias("audit_at"), F.col("evidence_json").alias("audit_evidence"))


def resolve_ids(ids: DataFrame, audit: DataFrame, bridge: DataFrame, with_evidence: bool = False) -> DataFrame:
    """State, key and rule of every approach id (column `neows_id`, distinct); other columns of `ids` stay.

    The newest audit row answers; only without one does the bridge, by how many entities it names.
    """
    keys = keys_per_identifier(bridge, V.APPROACH_FEED, "id", "bridge_id")
    found = ids.join(latest_audit(audit), F.col("neows_id") == F.col("audit_id"), "left").join(
        keys, F.col("neows_id") == F.col("bridge_id"), "left")
    digits = F.col("neows_id").rlike("^[0-9]+$")
    audited = F.col("audit_id").isNotNull()
    linked = (F.col("audit_state") == V.RESOLVED) & F.col("audit_key").isNotNull()
    refused = F.col("audit_state").isin(V.AMBIGUOUS, V.INVALID)
    one, several = F.col("key_count") == 1, F.col("key_count") > 1
    state = (
        F.when(~digits, V.INVALID)
        .when(audited & linked, V.RESOLVED).when(audited & refused, F.col("audit_state")).when(audited, V.UNRESOLVED)
        .when(one, V.RESOLVED).when(several, V.AMBIGUOUS).otherwise(V.UNRESOLVED)
    )
    key = F.when(~digits, None).when(audited, F.when(linked, F.col("audit_key"))).when(one, F.col("first_key"))
    rule = (
        F.when(~digits, V.INVALID_SYNTAX)
        .when(audited & (linked | refused), F.col("audit_rule"))
        .when(audited, F.coalesce("audit_rule", F.lit(V.NO_MATCH)))
        .when(one, V.BRIDGE_EXACT).when(several, V.BRIDGE_SEVERAL).otherwise(V.NO_RECORD)
    )
    out = [
        *ids.columns, state.alias("match_state"), key.alias("asteroid_key"), rule.alias("match_rule"),
        F.col("audit_at").alias("resolved_at"),
    ]
    if with_evidence:
        explain = (
            F.when(~digits, V.EVIDENCE_TEXT[V.INVALID_SYNTAX])
            .when(audited, F.col("audit_evidence"))
            .when(one, V.EVIDENCE_TEXT[V.BRIDGE_EXACT])
            .when(several, F.format_string(V.EVIDENCE_TEXT[V.BRIDGE_SEVERAL], F.col("key_count")))
            .otherwise(V.EVIDENCE_TEXT[V.NO_RECORD])
        )
        out.append(explain.alias("evidence"))
    return found.select(*out)


def threat_watchlist_view(
    approaches: DataFrame, risk: DataFrame, objects: DataFrame, orbits: DataFrame, elements: DataFrame,
    physical: DataFrame, bridge: DataFrame, as_of,
) -> DataFrame:
    """One row per (date, approach id) of the date-partitioned table, enriched through the bridge.

    Monitored means that some risk object with a lifecycle resolves to the same entity.
    """
    encounter = newest_partition(
        approaches.select("id", "name", "closest_approach_date", "miss_distance_km", "hazardous", "year", "month", "day"))
    keys = keys_per_identifier(bridge, V.APPROACH_FEED, "id", "bridge_id").select(
        "bridge_id", F.col("last_key").alias("asteroid_key"))
    rows = attach(encounter, keys, "id", "bridge_id", spread=["closest_approach_date"])

    rolled = risk_by_entity(risk, bridge, as_of)
    rolled = rolled.select(
        F.col("asteroid_key").alias("risk_key"), "sentry_identifier_count", "sentry_id",
        *[F.col(a).alias(f"sentry_{b}") for a, b in (
            ("latest_impact_probability", "impact_probability"), ("latest_palermo_scale_max", "palermo_scale_max"),
            ("latest_torino_scale_max", "torino_scale_max"), ("potential_impacts_count", "potential_impacts_count"),
            ("impact_year_range", "impact_year_range"), ("is_currently_active", "is_currently_active"),
            ("all_time_max_impact_probability", "all_time_max_impact_probability"),
            ("all_time_max_palermo_scale_max", "all_time_max_palermo_scale_max"),
            ("all_time_max_torino_scale_max", "all_time_max_torino_scale_max"))])
    described = characterization_profile(objects, orbits, elements, physical, bridge).drop("asteroid_key")
    described = described.select(
        F.col("spkid").alias("described_spkid"),
        *[F.col(c).alias(f"sbdb_{c}") for c in (
            "designation", "fullname", "orbit_class_name", "is_pha", "earth_moid_au", "condition_code",
            "data_arc_days", "n_obs_used")],
        F.col("astrometric_data_quality_tier").alias("tier"))
    pivots = pivot_spkids(bridge).select(F.col("asteroid_key").alias("pivot_key"), F.col("spkid").alias("pivot_spkid"))
    # Entities first (one row each), then one join to the approaches.
    entity = pivots.join(described, F.col("pivot_spkid") == F.col("described_spkid"), "left").join(
        rolled, F.col("pivot_key") == F.col("risk_key"), "full")
    entity = entity.withColumn("entity_key", F.coalesce("pivot_key", "risk_key"))
    rows = attach(rows, entity, "asteroid_key", "entity_key", spread=["id"])
    count = F.coalesce("sentry_identifier_count", F.lit(0))
    return rows.select(
        "closest_approach_date", F.col("id").alias("neows_id"), F.col("name").alias("neo_name"), "miss_distance_km",
        lunar_distances(F.col("miss_distance_km")).alias("miss_distance_lunar"),
        F.col("hazardous").alias("is_neo_hazardous"), "asteroid_key",
        (count > 0).alias("is_sentry_monitored"), (count > 1).alias("is_sentry_ambiguous"),
        count.cast("bigint").alias("sentry_identifier_count"), "sentry_id", "sentry_impact_probability",
        "sentry_palermo_scale_max", "sentry_torino_scale_max", "sentry_potential_impacts_count",
        "sentry_impact_year_range", "sentry_is_currently_active", "sentry_all_time_max_impact_probability",
        "sentry_all_time_max_palermo_scale_max", "sentry_all_time_max_torino_scale_max",
        F.col("described_spkid").alias("sbdb_spkid"),
        "sbdb_designation", "sbdb_fullname", "sbdb_orbit_class_name", "sbdb_is_pha", "sbdb_earth_moid_au",
        "sbdb_condition_code", "sbdb_data_arc_days", "sbdb_n_obs_used",
        F.coalesce("tier", F.lit(V.UNREPORTED)).alias("sbdb_astrometric_quality_tier"),
    )


def linked_risk(risk: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per entity with a risk link: link count, and the latest values when there is one link."""
    latest = latest_by(
        risk.select("sentry_id", "snapshot_key", "snapshot_time", "run_id", "impact_probability", "palermo_scale_max",
                    "torino_scale_max", "potential_impacts_count", "impact_year_range"),
        ["sentry_id"], ["snapshot_key", "snapshot_time", "run_id"])
    links = bridge.filter((F.col("source_system") == V.RISK_FEED) & (F.col("identifier_name") == "sentry_id")).select(
        "asteroid_key", "identifier_value").distinct()
    rows = links.join(latest, F.col("identifier_value") == F.col("sentry_id"), "left")
    one = F.count("identifier_value") == 1
    return rows.groupBy(F.col("asteroid_key").alias("risk_key")).agg(
        F.count("identifier_value").alias("links"),
        F.when(one, F.max("identifier_value")).alias("sentry_id"),
        *[F.when(one, F.max(c)).alias(f"sentry_{c}") for c in (
            "impact_probability", "palermo_scale_max", "torino_scale_max", "potential_impacts_count", "impact_year_range")],
    )


def closest_per_day(approaches: DataFrame) -> DataFrame:
    """One row per (approach id, date): the closest of its copies."""
    return first_by(
        approaches.select(F.col("id").alias("neows_id"), "name", "closest_approach_date", "miss_distance_km", "hazardous"),
        ["neows_id", "closest_approach_date"], ["miss_distance_km"])


def described_ids(ids: DataFrame, risk: DataFrame, objects: DataFrame, bridge: DataFrame, audit: DataFrame) -> DataFrame:
    """Distinct approach ids (`neows_id`; other columns stay) with their resolution, risk links and catalog object."""
    state = resolve_ids(ids, audit, bridge)
    pivots = pivot_spkids(bridge).select(F.col("asteroid_key").alias("pivot_key"), F.col("spkid").alias("sbdb_spkid"))
    latest = latest_by(
        objects.select("spkid", "snapshot_key", "snapshot_time", "run_id", "designation", "fullname", "orbit_class_name"),
        ["spkid"], ["snapshot_key", "snapshot_time", "run_id"],
    ).select(F.col("spkid").alias("described_spkid"), F.col("designation").alias("sbdb_designation"),
             F.col("fullname").alias("sbdb_fullname"), F.col("orbit_class_name").alias("sbdb_orbit_class_name"))
    entity = pivots.join(latest, F.col("sbdb_spkid") == F.col("described_spkid"), "left").join(
        linked_risk(risk, bridge), F.col("pivot_key") == F.col("risk_key"), "full",
    ).withColumn("entity_key", F.coalesce("pivot_key", "risk_key"))
    rows = attach(state, entity, "asteroid_key", "entity_key", spread=["neows_id"])
    return rows.select(
        *ids.columns, "asteroid_key", "match_state",
        (F.coalesce("links", F.lit(0)) > 0).alias("is_sentry_monitored"),
        (F.coalesce("links", F.lit(0)) > 1).alias("is_sentry_ambiguous"),
        "sentry_id", "sentry_impact_probability", "sentry_palermo_scale_max", "sentry_torino_scale_max",
        "sentry_potential_impacts_count", "sentry_impact_year_range",
        F.col("sbdb_spkid").isNotNull().alias("has_sbdb_characterization"),
        "sbdb_spkid", "sbdb_designation", "sbdb_fullname", "sbdb_orbit_class_name",
    )


def threat_watchlist(
    approaches: DataFrame, risk: DataFrame, objects: DataFrame, bridge: DataFrame, audit: DataFrame
) -> DataFrame:
    """One row per (date, approach id), the closest of its copies, with resolution state and links.

    Monitored here means a risk identifier in the bridge, with or without risk rows.
    """
    # Ids are distinct here, so a busy object meets its entity once, before its approaches multiply.
    ids = approaches.select(F.col("id").alias("neows_id")).distinct()
    per_id = described_ids(ids, risk, objects, bridge, audit)
    rows = closest_per_day(approaches).join(per_id, "neows_id", "inner")
    return rows.select(
        "closest_approach_date", "neows_id", "name", "miss_distance_km",
        lunar_distances(F.col("miss_distance_km")).alias("miss_distance_lunar"), "hazardous",
        *[c for c in per_id.columns if c != "neows_id"],
    )


def filter_watchlist(
    watchlist: DataFrame, hazardous: bool | None = None, sentry_monitored: bool | None = None,
    horizon_mkm: float | None = None,
) -> DataFrame:
    """The three filters; a NULL hazard flag matches neither value, the horizon is inclusive."""
    if hazardous is not None:
        watchlist = watchlist.filter(F.col("hazardous") == hazardous)
    if sentry_monitored is not None:
        watchlist = watchlist.filter(F.col("is_sentry_monitored") == sentry_monitored)
    if horizon_mkm is not None:
        if horizon_mkm <= 0:
            raise ValueError("horizon_mkm must be positive")
        watchlist = watchlist.filter(F.col("miss_distance_km") <= float(horizon_mkm) * 1_000_000.0)
    return watchlist


def watchlist_page(watchlist: DataFrame, limit: int = 50, offset: int = 0, **filters) -> tuple[DataFrame, DataFrame]:
    """One page, closest first, and the page figures."""
    return page(filter_watchlist(watchlist, **filters), WATCHLIST_ORDER, limit, offset)
