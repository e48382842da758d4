"""The world snapshot: every object once, at its closest approach, with identity and availability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.functions.availability import catalog_status, risk_status
from perigee.functions.keys import unit_direction
from perigee.operators.ordering import page_of, publish_in_order
from perigee.operators.picking import closest_encounter, latest_by, preferred_pivot
from perigee.plans.catalog import coherent_snapshot
from perigee.plans.watchlist import resolve_ids
from perigee.runtime import attach, one_row
from perigee.schemas import OPTIONAL_APPROACH_COLUMNS, RISK_ASSESSMENT_COLUMNS

WORLD_ORDER = ["miss_distance_km", "neows_id"]


def with_optional_columns(approaches: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add the optional columns an older dataset lacks as typed NULLs, and name them."""
    missing = [c for c in OPTIONAL_APPROACH_COLUMNS if c not in approaches.columns]
    for name in missing:
        approaches = approaches.withColumn(name, F.lit(None).cast(OPTIONAL_APPROACH_COLUMNS[name]))
    return approaches, missing


def risk_links(bridge: DataFrame) -> DataFrame:
    """Per entity: how many non-empty risk identifiers it has, and the smallest."""
    wanted = (F.col("source_system") == V.RISK_FEED) & (F.col("identifier_name") == "sentry_id")
    links = bridge.filter(wanted & (F.col("identifier_value") != "")).select("asteroid_key", "identifier_value").distinct()
    return links.groupBy(F.col("asteroid_key").alias("link_key")).agg(
        F.count(F.lit(1)).alias("links"), F.min("identifier_value").alias("link_id"))


def world_snapshot(
    approaches: DataFrame, risk: DataFrame, objects: DataFrame, orbits: DataFrame, bridge: DataFrame,
    audit: DataFrame, neows_id: str | None = None, profile: DataFrame | None = None,
) -> DataFrame:
    """The flat world rows. With `neows_id` the scan itself is restricted.

    A `profile` (one row per object of the catalog, from `snapshot_profile`) takes the place of the
    catalog's tables; its rows come along as the struct `cat`.
    """
    if neows_id is not None:
        approaches = approaches.filter(F.col("id") == neows_id)
    approaches, _ = with_optional_columns(approaches)
    core = ["id", "name", "closest_approach_date", "miss_distance_km", "hazardous", *OPTIONAL_APPROACH_COLUMNS]
    near = closest_encounter(approaches.select(*core)).withColumnRenamed("id", "neows_id")
    near = resolve_ids(near, audit, bridge)

    # Everything about an entity is gathered per entity first: one row per key.
    latest = latest_by(
        risk.select("sentry_id", "snapshot_key", "snapshot_time", "run_id", *RISK_ASSESSMENT_COLUMNS),
        ["sentry_id"], ["snapshot_key", "snapshot_time", "run_id"],
    ).select(
        F.col("sentry_id").alias("record_id"), F.col("snapshot_key").alias("sentry_snapshot_key"),
        F.col("run_id").alias("sentry_run_id"), F.col("snapshot_time").alias("sentry_snapshot_time"),
        *[F.col(c).alias(f"sentry_{c}") for c in RISK_ASSESSMENT_COLUMNS])
    links = attach(
        risk_links(bridge).withColumn("sole_id", F.when(F.col("links") == 1, F.col("link_id"))),
        latest, "sole_id", "record_id", spread=["link_key"])
    carried = [] if profile is None else ["cat"]
    snapshot = coherent_snapshot(objects, orbits) if profile is None else profile.withColumn("cat", F.struct(*profile.columns))
    snapshot = snapshot.select(
        F.col("spkid").alias("snapshot_spkid"), F.col("snapshot_key").alias("sbdb_snapshot_key"),
        F.col("run_id").alias("sbdb_run_id"), *carried)
    pivots = preferred_pivot(bridge, V.CATALOG_FEED, "spkid").select(
        F.col("asteroid_key").alias("pivot_key"), F.col("spkid").alias("sbdb_spkid"))
    cataloged = pivots.join(snapshot, F.col("sbdb_spkid") == F.col("snapshot_spkid"), "left")
    # Both sides of an entity meet the objects by the same key, so that each is shuffled by it once.
    rows = attach(near, cataloged, "asteroid_key", "pivot_key", spread=["neows_id"],
                  when=F.col("match_state") == V.RESOLVED, also=[(links, "link_key")])
    catalog = one_row(risk.agg(F.max("snapshot_key").alias("sentry_latest_catalog_snapshot_key")))
    return rows.crossJoin(catalog).select(
        "neows_id", "name", "closest_approach_date", "miss_distance_km", "hazardous", *OPTIONAL_APPROACH_COLUMNS,
        "match_state", "asteroid_key", "match_rule", "resolved_at", "sbdb_spkid", "sbdb_snapshot_key", "sbdb_run_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("sentry_link_count"), F.col("sole_id").alias("sentry_id"),
        "sentry_snapshot_key", "sentry_run_id", "sentry_snapshot_time",
        *[f"sentry_{c}" for c in RISK_ASSESSMENT_COLUMNS], "sentry_latest_catalog_snapshot_key", *carried,
    )


def publish_world(flat: DataFrame, path: str) -> DataFrame:
    """Store the world rows closest first, ties by id, with the manifest that readers take the order from."""
    return publish_in_order(flat, WORLD_ORDER, path)


def nearest_objects(spark: SparkSession, path: str, limit: int = 50, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """One page of the published world, in its order, and the page's figures."""
    return page_of(spark, path, limit, offset)


def catalog_block(row=F.col):
    """Struct (status, spkid, snapshot_key, run_id) of a flat world row."""
    status = catalog_status(row("match_state"), row("sbdb_spkid"), row("sbdb_snapshot_key"))
    here = status == V.AVAILABLE
    return F.struct(
        status.alias("status"), F.when(status != V.NOT_RESOLVED, row("sbdb_spkid")).alias("spkid"),
        F.when(here, row("sbdb_snapshot_key")).alias("snapshot_key"), F.when(here, row("sbdb_run_id")).alias("run_id"))


def risk_block(row=F.col):
    """Struct (status, sentry_id, latest_snapshot_key, run_id, in_latest_catalog) of a flat world row."""
    status = risk_status(row("match_state"), row("sentry_link_count"), row("sentry_snapshot_key"))
    here = status == V.AVAILABLE
    return F.struct(
        status.alias("status"),
        F.when(status.isin(V.AVAILABLE, V.LINKED_NO_RECORD), row("sentry_id")).alias("sentry_id"),
        F.when(here, row("sentry_snapshot_key")).alias("latest_snapshot_key"),
        F.when(here, row("sentry_run_id")).alias("run_id"),
        F.when(here, row("sentry_snapshot_key") == row("sentry_latest_catalog_snapshot_key")).alias("in_latest_catalog"))


def world_records(flat: DataFrame) -> DataFrame:
    """The nested record per object."""
    encounter = ["close_approach_datetime", "relative_velocity_km_s", "estimated_diameter_min_km", "estimated_diameter_max_km"]
    return flat.select(
        "neows_id", "name", F.when(F.col("match_state") == V.RESOLVED, F.col("asteroid_key")).alias("asteroid_key"),
        F.struct("closest_approach_date", "miss_distance_km", F.col("hazardous").alias("is_potentially_hazardous"),
                 *encounter).alias("encounter"),
        F.struct("match_state", "match_rule", "resolved_at").alias("resolution"),
        catalog_block().alias("sbdb"), risk_block().alias("sentry"),
        unit_direction(F.col("neows_id")).alias("illustrative_direction"),
    )


NO_LINEAGE = "struct<dataset_run_id:string,source_raw_file:string,source_raw_sha256:string>"


def world_info(flat: DataFrame, missing_columns: list[str], lineage: DataFrame | None = None) -> DataFrame:
    """The one-row header of a world snapshot; `lineage` is `dataset_lineage` of the run table, else unknown."""
    info = flat.agg(
        F.count(F.lit(1)).alias("object_count"),
        F.max("sentry_latest_catalog_snapshot_key").alias("sentry_latest_catalog_snapshot_key"),
    ).select(
        "object_count", F.lit(V.CLOSEST_APPROACH_RULE).alias("encounter_selection_rule"),
        "sentry_latest_catalog_snapshot_key",
        F.array(*[F.lit(c) for c in missing_columns]).cast("array<string>").alias("neows_fields_not_in_dataset"),
        F.struct(F.lit(V.DIRECTION_SEMANTICS).alias("direction_semantics"), F.lit(V.DIRECTION_ALGORITHM).alias("direction_algorithm"),
                 F.lit(DIRECTION_NOTE).alias("note")).alias("spatial_model"),
    )
    return info.withColumn("neows", F.lit(None).cast(NO_LINEAGE)) if lineage is None else info.crossJoin(one_row(lineage))


DIRECTION_NOTE = "Distances are real; directions follow from the id alone and are no positions in the sky."


def world_envelope(info: DataFrame) -> DataFrame:
    """The header as a JSON text (`world_json`), for a response that carries records beside it."""
    return info.select(F.to_json(F.struct(*info.columns), {"ignoreNullFields": "false"}).alias("world_json"))
