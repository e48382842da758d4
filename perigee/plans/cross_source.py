"""One row per entity across the three feeds, and the audit of how well they were linked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.plans.catalog import characterization_profile
from perigee.plans.risk_history import risk_by_entity
from perigee.runtime import one_row


def approach_summary(approaches: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per entity: distinct approaches, first and last date, smallest distance, any hazard flag.

    Approaches are reduced to one row per (id, date) before they meet the bridge.
    """
    seen = approaches.groupBy("id", "closest_approach_date").agg(
        F.min("miss_distance_km").alias("km"), F.max(F.coalesce("hazardous", F.lit(False))).alias("hazardous"))
    # Then per id, so the join carries one row per object however often it came by.
    per_id = seen.groupBy("id").agg(
        F.count("closest_approach_date").alias("n"), F.min("closest_approach_date").alias("first"),
        F.max("closest_approach_date").alias("last"), F.min("km").alias("km"), F.max("hazardous").alias("hazardous"))
    links = bridge.filter((F.col("source_system") == V.APPROACH_FEED) & (F.col("identifier_name") == "id")).select(
        "asteroid_key", F.col("identifier_value").alias("id")).distinct()
    return per_id.join(links, "id").groupBy("asteroid_key").agg(
        F.sum("n").alias("neows_total_approaches_recorded"),
        F.min("first").alias("neows_earliest_approach_date"),
        F.max("last").alias("neows_latest_approach_date"),
        F.min("km").alias("neows_min_miss_distance_km"),
        F.max("hazardous").alias("is_classified_hazardous_neows"),
    )


def cross_source_profile(
    approaches: DataFrame, risk: DataFrame, objects: DataFrame, orbits: DataFrame, elements: DataFrame,
    physical: DataFrame, bridge: DataFrame, as_of,
) -> DataFrame:
    """One row per entity of the bridge. All sides are keyed by the entity and joined on it."""
    entities = bridge.select("asteroid_key").distinct()
    described = characterization_profile(objects, orbits, elements, physical, bridge).drop("asteroid_key")
    pivots = bridge.filter(
        (F.col("source_system") == V.CATALOG_FEED) & (F.col("identifier_name") == "spkid") & F.col("is_primary_pivot")
    ).select("asteroid_key", F.col("identifier_value").alias("canonical_spkid"))
    catalog = pivots.join(described, F.col("canonical_spkid") == F.col("spkid"), "left")
    rolled = risk_by_entity(risk, bridge, as_of).withColumn("has_risk", F.lit(True))
    met = approach_summary(approaches, bridge).withColumn("has_approach", F.lit(True))
    rows = entities.join(catalog, "asteroid_key", "left").join(met, "asteroid_key", "left").join(
        rolled, "asteroid_key", "left")
    count = F.coalesce("sentry_identifier_count", F.lit(0))
    false = F.lit(False)
    return rows.select(
        "asteroid_key", "canonical_spkid", F.col("designation").alias("canonical_designation"),
        F.col("fullname").alias("canonical_fullname"),
        F.coalesce("has_approach", false).alias("has_neows_telemetry"),
        F.col("spkid").isNotNull().alias("has_sbdb_characterization"),
        (F.coalesce("has_risk", false) & (count > 0)).alias("has_sentry_monitoring"),
        "neows_total_approaches_recorded", "neows_earliest_approach_date", "neows_latest_approach_date",
        "neows_min_miss_distance_km",
        F.coalesce("is_classified_hazardous_neows", false).alias("is_classified_hazardous_neows"),
        *[F.col(c).alias(f"sbdb_{c}") for c in (
            "orbit_class_name", "is_pha", "earth_moid_au", "condition_code", "data_arc_days",
            "estimated_diameter_km", "absolute_magnitude")],
        F.coalesce("astrometric_data_quality_tier", F.lit(V.UNREPORTED)).alias("sbdb_astrometric_quality_tier"),
        (count > 1).alias("is_sentry_ambiguous"), count.cast("bigint").alias("sentry_identifier_count"), "sentry_id",
        F.col("is_currently_active").alias("sentry_is_currently_active"),
        F.col("total_snapshots_observed").alias("sentry_total_snapshots_observed"),
        F.col("latest_impact_probability").alias("sentry_latest_impact_probability"),
        F.col("all_time_max_impact_probability").alias("sentry_all_time_max_impact_probability"),
        F.col("latest_palermo_scale_max").alias("sentry_latest_palermo_scale_max"),
        F.col("all_time_max_palermo_scale_max").alias("sentry_all_time_max_palermo_scale_max"),
        F.col("latest_torino_scale_max").alias("sentry_latest_torino_scale_max"),
        F.col("all_time_max_torino_scale_max").alias("sentry_all_time_max_torino_scale_max"),
        F.col("potential_impacts_count").alias("sentry_potential_impacts_count"),
        F.col("impact_year_range").alias("sentry_impact_year_range"),
        F.coalesce("is_crosswalk_ambiguous", false).alias("is_crosswalk_ambiguous"),
    )


def latest_run(audit: DataFrame) -> DataFrame:
    """The one-row id of the newest resolution run: an aggregate, not a global window."""
    newest = audit.agg(F.max(F.struct("resolved_at", "resolution_run_id")).alias("r"))
    return one_row(newest.select(F.col("r.resolution_run_id").alias("latest_run_id")))


def crosswalk_coverage_audit(audit: DataFrame) -> DataFrame:
    """Evaluations of the newest run per (system, state, rule) and their share of the system."""
    current = audit.join(latest_run(audit), F.col("resolution_run_id") == F.col("latest_run_id"), "left_semi")
    cells = current.groupBy("source_system", "match_state", "match_rule", "assigned_asteroid_key").agg(
        F.count(F.lit(1)).alias("n"), F.max("resolution_run_id").alias("run"), F.max("resolved_at").alias("at"))
    groups = cells.groupBy("source_system", "match_state", "match_rule").agg(
        F.sum("n").alias("evaluation_count"),
        F.count("assigned_asteroid_key").alias("resolved_to_canonical_key_count"),
        F.max("run").alias("resolution_run_id"), F.max("at").alias("resolved_at"))
    totals = groups.groupBy("source_system").agg(F.sum("evaluation_count").alias("total_source_system_evaluations"))
    return groups.join(totals, "source_system").select(
        "source_system", "match_state", "match_rule", "evaluation_count", "total_source_system_evaluations",
        F.round(F.col("evaluation_count") / F.col("total_source_system_evaluations") * 100.0, 4).alias(
            "pct_of_source_system"),
        "resolved_to_canonical_key_count", "resolution_run_id", "resolved_at",
    )
