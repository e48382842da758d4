"""Answers about single objects, computed for every object at once.

Each takes an optional id; the filter sits on a partitioning key of the plan, so Catalyst pushes it
to the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.functions.availability import override_reason, risk_gap_reason, section
from perigee.functions.orbit import lunar_distances
from perigee.functions.text import empty_to_null
from perigee.operators.picking import distinct_identifiers
from perigee.plans.catalog import catalog_profile, snapshot_profile
from perigee.plans.risk_history import risk_history
from perigee.plans.watchlist import closest_per_day, described_ids, resolve_ids
from perigee.plans.world import NO_LINEAGE, catalog_block, risk_block, with_optional_columns, world_snapshot
from perigee.runtime import attach, one_row
from perigee.schemas import RISK_ASSESSMENT_COLUMNS

ORBIT_SECTION = [
    "orbit_class_code", "orbit_class_name", "is_neo", "is_pha", "orbit_id", "epoch_jd", "equinox", "semi_major_axis_au",
    "eccentricity", "perihelion_distance_au", "aphelion_distance_au", "inclination_deg", "ascending_node_longitude_deg",
    "argument_of_perihelion_deg", "mean_anomaly_deg", "mean_motion_deg_per_day", "orbital_period_days",
    "time_of_perihelion_jd_tdb", "soln_date", "first_obs", "last_obs", "data_arc_days", "n_obs_used", "condition_code",
    "rms", "earth_moid_au", "jupiter_moid_au", "t_jup",
]
PHYSICAL_SECTION = ["absolute_magnitude", "estimated_diameter_km", "albedo", "rotational_period_hr"]
APPROACH_PHYSICAL_SECTION = ["absolute_magnitude_h", "estimated_diameter_min_km", "estimated_diameter_max_km"]


def risk_profile(risk: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per entity: no link, several links (everything withheld), or one link with its record."""
    entities = bridge.select("asteroid_key").distinct()
    links = distinct_identifiers(bridge, V.RISK_FEED, "sentry_id").groupBy("asteroid_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("identifier_value").alias("link_id"))
    order = F.struct("snapshot_key", "snapshot_time", "run_id")
    carried = ["designation", "fullname", "impact_probability", "palermo_scale_max", "palermo_scale_cum",
               "torino_scale_max", "potential_impacts_count", "v_infinity_km_s", "impact_year_range", "last_obs_date"]
    maxima = ["impact_probability", "palermo_scale_max", "torino_scale_max"]
    per_day = risk.groupBy("sentry_id", "snapshot_key").agg(
        F.max_by(F.struct(*carried), order).alias("row"), *[F.max(m).alias(f"top_{m}") for m in maxima])
    record = per_day.groupBy(F.col("sentry_id").alias("record_id")).agg(
        F.max_by("row", "snapshot_key").alias("row"), F.max("snapshot_key").alias("latest_snapshot_key"),
        F.count("snapshot_key").alias("days"), *[F.max(f"top_{m}").alias(f"all_time_max_{m}") for m in maxima])
    newest = one_row(risk.agg(F.max("snapshot_key").alias("newest_key")))
    joined = entities.join(links, "asteroid_key", "left").withColumn("sole", F.when(F.col("n") == 1, F.col("link_id")))
    joined = attach(joined, record, "sole", "record_id", spread=["asteroid_key"]).crossJoin(newest)
    n = F.coalesce("n", F.lit(0))
    row = F.col("row")
    return joined.select(
        "asteroid_key", (n > 0).alias("has_sentry_monitoring"), (n > 1).alias("is_sentry_ambiguous"),
        n.cast("bigint").alias("sentry_identifier_count"), F.col("sole").alias("sentry_id"),
        row["designation"].alias("designation"), row["fullname"].alias("fullname"),
        *[row[c].alias(f"latest_{c}") for c in (
            "impact_probability", "palermo_scale_max", "palermo_scale_cum", "torino_scale_max", "potential_impacts_count")],
        *[row[c].alias(c) for c in ("v_infinity_km_s", "impact_year_range", "last_obs_date")],
        "latest_snapshot_key", F.coalesce("days", F.lit(0)).cast("bigint").alias("total_snapshots_observed"),
        *[f"all_time_max_{m}" for m in maxima],
        F.coalesce(F.col("latest_snapshot_key") == F.col("newest_key"), F.lit(False)).alias("is_currently_active"),
    )


def crosswalk(bridge: DataFrame, asteroid_key: str | None = None) -> DataFrame:
    """All identifiers of an entity: the pivot first, then by system and name."""
    if asteroid_key is not None:
        bridge = bridge.filter(F.col("asteroid_key") == asteroid_key.strip())
    return bridge.orderBy(
        "asteroid_key", F.col("is_primary_pivot").desc_nulls_last(), "source_system", "identifier_name", "identifier_value")


def asteroid_detail(
    approaches: DataFrame, risk: DataFrame, objects: DataFrame, bridge: DataFrame, audit: DataFrame, neows_id: str | None = None,
) -> DataFrame:
    """One row per approach id: its closest encounter, on how many days one was recorded, and its identity.

    Each table of facts is read once: one aggregate per id picks the row and counts the days, and the
    identity is looked up for its result. NULL distances and dates come last, the other columns break ties.
    """
    if neows_id is not None:
        approaches = approaches.filter(F.col("id") == neows_id)
    order = ["miss_distance_km", "closest_approach_date"]
    row = F.struct(*[part for c in order for part in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))], "name", "hazardous")
    near = closest_per_day(approaches).groupBy("neows_id").agg(
        F.min(row).alias("near"), F.count(F.lit(1)).alias("approaches_recorded_count"))
    return described_ids(near, risk, objects, bridge, audit).select(
        "neows_id", "near.name", "near.closest_approach_date", "near.miss_distance_km",
        lunar_distances(F.col("near.miss_distance_km")).alias("miss_distance_lunar"), "near.hazardous",
        "approaches_recorded_count", F.lit(V.CLOSEST_APPROACH_RULE).alias("selection_rule"), "asteroid_key", "match_state",
        "is_sentry_monitored", "is_sentry_ambiguous", "sentry_id", "has_sbdb_characterization", "sbdb_spkid",
        "sbdb_designation", "sbdb_fullname", "sbdb_orbit_class_name",
    )


def _identities(approaches: DataFrame, audit: DataFrame, bridge: DataFrame, neows_id: str | None) -> DataFrame:
    ids = approaches.select(F.col("id").alias("neows_id")).distinct()
    if neows_id is not None:
        ids = ids.filter(F.col("neows_id") == neows_id)
    return resolve_ids(ids, audit, bridge, with_evidence=True)


def _answered(state: DataFrame, answer: DataFrame) -> DataFrame:
    """Each identity with the answer struct of its entity, if it is resolved and has one."""
    keyed = answer.select(F.col("asteroid_key").alias("answer_key"), F.struct(*answer.columns).alias("data"))
    return attach(state, keyed, "asteroid_key", "answer_key", spread=["neows_id"],
                  when=F.col("match_state") == V.RESOLVED).drop("answer_key")


def catalog_answers(approaches, audit, bridge, objects, orbits, elements, physical, neows_id=None) -> DataFrame:
    """Per approach id: identity and, if resolved, the catalog profile struct (else NULL)."""
    profile = catalog_profile(objects, orbits, elements, physical, bridge)
    return _answered(_identities(approaches, audit, bridge, neows_id), profile)


def risk_answers(approaches, audit, bridge, risk, neows_id=None) -> DataFrame:
    """Per approach id: identity and, if resolved, the risk profile struct; unmonitored is a record too."""
    return _answered(_identities(approaches, audit, bridge, neows_id), risk_profile(risk, bridge))


AMBIGUITY_NOTE = "Historical identity cannot be uniquely established due to ambiguous Sentry linkage."


def history_answers(approaches, audit, bridge, risk, neows_id=None) -> DataFrame:
    """Per approach id: identity, linkage flags and the number of stored snapshots.

    `snapshots` is NULL where no history can be attributed and 0 where one is linked but empty; the
    rows themselves come from `history_rows`, never collected into one cell.
    """
    state = _identities(approaches, audit, bridge, neows_id)
    links = distinct_identifiers(bridge, V.RISK_FEED, "sentry_id").groupBy(F.col("asteroid_key").alias("link_key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("identifier_value").alias("link_id"))
    days = risk.groupBy("sentry_id", "snapshot_key").agg(F.lit(1).alias("one")).groupBy(
        F.col("sentry_id").alias("days_id")).agg(F.count(F.lit(1)).alias("days"))
    links = links.join(days, F.col("link_id") == F.col("days_id"), "left")
    rows = attach(state, links, "asteroid_key", "link_key", spread=["neows_id"], when=F.col("match_state") == V.RESOLVED)
    several = F.coalesce(F.col("n") > 1, F.lit(False))
    return rows.select(
        *state.columns, several.alias("is_sentry_ambiguous"), F.when(several, AMBIGUITY_NOTE).alias("warning"),
        F.when(F.col("n") == 1, F.col("link_id")).alias("sentry_id"),
        F.when(F.col("n") == 1, F.coalesce("days", F.lit(0))).alias("snapshots"),
    )


def history_rows(answers: DataFrame, risk: DataFrame) -> DataFrame:
    """The stored trajectory of every approach id with exactly one risk link."""
    linked = answers.filter(F.col("sentry_id").isNotNull()).select("neows_id", "sentry_id")
    return linked.join(risk_history(risk), "sentry_id")


def crosswalk_answers(approaches, audit, bridge, neows_id=None) -> DataFrame:
    """One row per (approach id, identifier of its entity); an id without any keeps one empty row."""
    state = _identities(approaches, audit, bridge, neows_id)
    resolved = F.when(F.col("match_state") == V.RESOLVED, F.col("asteroid_key"))
    probe = state.withColumn("join_key", F.coalesce(resolved, F.concat(F.lit("none:"), "neows_id")))
    rows = bridge.select(F.col("asteroid_key").alias("join_key"), "source_system", "identifier_name", "identifier_value",
                         "is_primary_pivot")
    return probe.join(rows, "join_key", "left").drop("join_key")


def unified_profile(
    approaches: DataFrame, risk: DataFrame, objects: DataFrame, orbits: DataFrame, elements: DataFrame,
    physical: DataFrame, bridge: DataFrame, audit: DataFrame, neows_id: str | None = None, lineage: DataFrame | None = None,
) -> DataFrame:
    """One nested profile per approach id, every section with its availability and provenance.

    The identifier list of the entity is `crosswalk_answers`, one row per identifier. `lineage` is the
    one row of `dataset_lineage`; without it the run of the approach dataset is unknown.
    """
    _, missing = with_optional_columns(approaches)
    rows = world_snapshot(
        approaches, risk, objects, orbits, bridge, audit, neows_id, snapshot_profile(objects, orbits, elements, physical))
    rows = rows.withColumn("cat", F.when((F.col("match_state") == V.RESOLVED) & F.col("sbdb_snapshot_key").isNotNull(), F.col("cat")))
    rows = rows.withColumn("neows", F.lit(None).cast(NO_LINEAGE)) if lineage is None else rows.crossJoin(one_row(lineage))
    rows = rows.withColumn("sbdb", catalog_block()).withColumn("sentry", risk_block())
    state = F.col("match_state")
    resolved = state == V.RESOLVED
    cat = F.col("cat")
    no_catalog = F.when(cat.isNotNull(), None).when(~resolved, V.NOT_RESOLVED).otherwise(V.NOT_IN_SOURCE)
    older = F.array(*[F.lit(c) for c in missing]).cast("array<string>")

    identity = {
        "asteroid_key": F.when(resolved, F.col("asteroid_key")), "sbdb_spkid": F.col("sbdb.spkid"),
        "sbdb_designation": cat["designation"], "sbdb_fullname": cat["fullname"], "sentry_id": F.col("sentry.sentry_id"),
    }
    block = section(identity, F.when(~resolved, F.lit(V.NOT_RESOLVED)))
    block = override_reason(block, ["sbdb_designation", "sbdb_fullname"], V.NOT_IN_SOURCE,
                            F.col("sbdb.spkid").isNotNull() & cat.isNull())
    block = override_reason(block, ["sentry_id"], V.AMBIGUOUS_LINKAGE, F.col("sentry.status") == V.LINK_AMBIGUOUS)
    orbit = {c: cat[c] for c in ORBIT_SECTION}
    body = {c: cat[c] for c in PHYSICAL_SECTION}
    estimate = {c: F.col(c) for c in APPROACH_PHYSICAL_SECTION}
    encounter = {
        "is_potentially_hazardous": F.col("hazardous"), "close_approach_datetime": F.col("close_approach_datetime"),
        "close_approach_epoch_ms": F.col("close_approach_epoch_ms"),
        "relative_velocity_km_s": F.col("relative_velocity_km_s"), "is_sentry_object": F.col("is_sentry_object"),
    }
    here = F.col("sentry.status") == V.AVAILABLE
    assessed = {}
    for name, kind in RISK_ASSESSMENT_COLUMNS.items():
        value = F.col(f"sentry_{name}")
        assessed[name] = F.when(here, empty_to_null(value) if kind == "string" else value)

    def block_of(values, availability, *more):
        return F.struct(*[v.alias(k) for k, v in values.items()], *more, availability.alias("availability"))

    none = F.lit(None).cast("string")
    linked = F.col("sentry.status").isin(V.AVAILABLE, V.LINKED_NO_RECORD)
    return rows.select(
        "neows_id",
        block_of(identity, block, F.col("neows_id").alias("neows_id"), F.col("name").alias("name"),
                 state.alias("match_state")).alias("identity"),
        block_of(orbit, section(orbit, no_catalog)).alias("orbit"),
        block_of(body, section(body, no_catalog)).alias("physical"),
        block_of(estimate, section(estimate, none, older)).alias("neows_physical"),
        block_of(encounter, section(encounter, none, older), F.lit(V.CLOSEST_APPROACH_RULE).alias("selection_rule"),
                 F.col("closest_approach_date").alias("closest_approach_date"),
                 F.col("miss_distance_km").alias("miss_distance_km")).alias("encounter"),
        F.struct(
            F.col("sentry.status").alias("status"), F.lit("sentry_mode_s_summary").alias("source_contract"),
            F.col("sentry.sentry_id").alias("sentry_id"), F.col("sentry.in_latest_catalog").alias("in_latest_catalog"),
            block_of(assessed, section(assessed, risk_gap_reason(F.col("sentry.status")))).alias("assessment"),
            F.when(linked, F.concat(F.lit("/asteroids/"), "neows_id", F.lit("/sentry"))).alias("assessment_endpoint"),
        ).alias("sentry"),
        F.struct(
            F.col("neows"),
            F.struct("match_rule", "resolved_at").alias("resolution"),
            F.struct(F.coalesce(cat["spkid"], F.col("sbdb.spkid")).alias("spkid"), cat["snapshot_key"].alias("snapshot_key"),
                     cat["run_id"].alias("run_id"), cat["snapshot_time"].alias("snapshot_time")).alias("sbdb"),
            F.struct(F.col("sentry.sentry_id").alias("sentry_id"),
                     F.col("sentry.latest_snapshot_key").alias("latest_snapshot_key"),
                     F.col("sentry.run_id").alias("run_id"),
                     F.when(here, F.col("sentry_snapshot_time")).alias("snapshot_time"),
                     F.col("sentry_latest_catalog_snapshot_key").alias("latest_catalog_snapshot_key")).alias("sentry"),
        ).alias("provenance"),
    )
