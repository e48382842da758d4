"""Catalog datasets: the characterization view, the coherent snapshot and the profile pinned to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions.orbit import period_from_axis, period_from_days, quality_tier
from perigee.operators.picking import latest_by, preferred_pivot
from perigee.operators.tallying import pivot_values
from perigee.vocabulary import CATALOG_FEED

SNAPSHOT_ORDER = ["snapshot_key", "snapshot_time", "run_id"]

# Output column -> stored element or parameter name.
VIEW_ELEMENTS = {
    "eccentricity": "e", "semi_major_axis_au": "a", "perihelion_distance_au": "q", "inclination_deg": "i",
}
PROFILE_ELEMENTS = {
    "eccentricity": "e",
    "semi_major_axis_au": "a",
    "perihelion_distance_au": "q",
    "aphelion_distance_au": "ad",
    "inclination_deg": "i",
    "ascending_node_longitude_deg": "om",
    "argument_of_perihelion_deg": "w",
    "mean_anomaly_deg": "ma",
    "mean_motion_deg_per_day": "n",
    "orbital_period_days": "per",
    "time_of_perihelion_jd_tdb": "tp",
}
PHYSICAL_PARAMETERS = {
    "estimated_diameter_km": "diameter", "absolute_magnitude": "H", "albedo": "albedo", "rotational_period_hr": "rot_per",
}
OBJECT_FIELDS = [
    "designation", "fullname", "shortname", "object_kind", "is_neo", "is_pha", "orbit_class_code", "orbit_class_name",
]
ORBIT_FIELDS = [
    "epoch_jd", "equinox", "soln_date", "orbit_source", "producer", "first_obs", "last_obs", "data_arc_days",
    "n_obs_used", "condition_code", "rms", "earth_moid_au", "jupiter_moid_au", "t_jup",
]


def primary_pivots(bridge: DataFrame) -> DataFrame:
    """spkid -> entity for the primary pivot rows."""
    rows = bridge.filter(
        (F.col("source_system") == CATALOG_FEED) & (F.col("identifier_name") == "spkid") & F.col("is_primary_pivot"))
    return rows.groupBy(F.col("identifier_value").alias("spkid")).agg(F.max("asteroid_key").alias("asteroid_key"))


def pivot_spkids(bridge: DataFrame) -> DataFrame:
    """entity -> spkid for the primary pivot rows."""
    rows = bridge.filter(
        (F.col("source_system") == CATALOG_FEED) & (F.col("identifier_name") == "spkid") & F.col("is_primary_pivot"))
    return rows.groupBy("asteroid_key").agg(F.max("identifier_value").alias("spkid"))


def characterization_profile(
    objects: DataFrame, orbits: DataFrame, elements: DataFrame, physical: DataFrame, bridge: DataFrame
) -> DataFrame:
    """One row per spkid: latest object and orbit, element and parameter maxima over all snapshots.

    Every side is aggregated by spkid, so the four joins reuse that partitioning.
    """
    obj = latest_by(objects.select("spkid", *SNAPSHOT_ORDER, *OBJECT_FIELDS, "orbit_id"), ["spkid"], SNAPSHOT_ORDER)
    orb = latest_by(
        orbits.select("spkid", *SNAPSHOT_ORDER, "orbit_id", "epoch_jd", "soln_date", "data_arc_days", "n_obs_used",
                      "condition_code", "rms", "earth_moid_au", "jupiter_moid_au", "t_jup"),
        ["spkid"], [*SNAPSHOT_ORDER, "orbit_id"]).drop(*SNAPSHOT_ORDER, "orbit_id")
    elem = pivot_values(elements, ["spkid"], "element_name", "element_value", VIEW_ELEMENTS)
    phys = pivot_values(physical, ["spkid"], "param_name", "param_value_numeric", PHYSICAL_PARAMETERS)
    joined = obj.drop(*SNAPSHOT_ORDER)
    for side in (orb, elem, phys, primary_pivots(bridge)):
        joined = joined.join(side, "spkid", "left")
    return joined.select(
        "spkid", "asteroid_key", *OBJECT_FIELDS, "orbit_id", "epoch_jd", "soln_date", "data_arc_days", "n_obs_used",
        "condition_code", "rms", "earth_moid_au", "jupiter_moid_au", "t_jup", *VIEW_ELEMENTS,
        period_from_axis(F.col("semi_major_axis_au")).alias("orbital_period_yr"),
        *PHYSICAL_PARAMETERS,
        quality_tier(F.col("data_arc_days"), F.col("n_obs_used"), F.col("condition_code")).alias(
            "astrometric_data_quality_tier"),
    )


def coherent_snapshot(objects: DataFrame, orbits: DataFrame) -> DataFrame:
    """The newest (snapshot_key, run_id) per object that wrote an object or an orbit row."""
    columns = ["spkid", *SNAPSHOT_ORDER]
    written = objects.select(*columns).unionByName(orbits.select(*columns))
    return latest_by(written, ["spkid"], SNAPSHOT_ORDER)


PIN = ["spkid", "snapshot_key", "run_id"]


def snapshot_contents(objects: DataFrame, orbits: DataFrame) -> DataFrame:
    """The coherent snapshot of each object with what it holds: structs `obj` and `orb`, NULL where absent.

    Object and orbit rows are tagged in one union, so each table is read once: one aggregate per (object,
    snapshot, run) picks a payload of either kind, one per object picks the newest snapshot with both. Rows
    are dealt out by object once, for both aggregates and for the joins that follow; nothing is sorted before.
    """
    obj = F.struct(*OBJECT_FIELDS, F.col("orbit_id").alias("object_orbit_id"))
    orb = F.struct("orbit_id", *ORBIT_FIELDS)
    none = lambda struct, table: F.lit(None).cast(table.select(struct.alias("s")).schema["s"].dataType)
    written = objects.select("spkid", *SNAPSHOT_ORDER, obj.alias("obj"), none(orb, orbits).alias("orb")).unionByName(
        orbits.select("spkid", *SNAPSHOT_ORDER, none(obj, objects).alias("obj"), orb.alias("orb"))).repartition("spkid")
    # max() ignores NULL, so each kind picks among its own rows.
    runs = written.groupBy(*PIN).agg(F.max("snapshot_time").alias("snapshot_time"), F.max("obj").alias("obj"), F.max("orb").alias("orb"))
    # A snapshot without key or run is never looked up.
    known = F.col("snapshot_key").isNotNull() & F.col("run_id").isNotNull()
    row = F.struct(*SNAPSHOT_ORDER, F.when(known, F.col("obj")).alias("obj"), F.when(known, F.col("orb")).alias("orb"))
    return runs.groupBy("spkid").agg(F.max(row).alias("row")).select("spkid", "row.*")


def snapshot_profile(objects: DataFrame, orbits: DataFrame, elements: DataFrame, physical: DataFrame) -> DataFrame:
    """One row per object of the catalog; every value comes from its one coherent snapshot.

    Each of the four tables is read once. Elements and parameters are pivoted per snapshot before they
    meet the snapshots, so a row per (snapshot, solution) is shuffled and not one per element.
    """
    anchor = snapshot_contents(objects, orbits)
    picks = [F.max(F.when(F.col("element_name") == n, F.col("element_value"))).alias(o) for o, n in PROFILE_ELEMENTS.items()]
    solved = elements.groupBy(*PIN, F.col("orbit_id").alias("element_orbit_id")).agg(*picks, F.max("equinox").alias("element_equinox"))
    joined = anchor.join(solved, PIN, "left")
    # With a known solution only its elements count; without one, all of the snapshot's do.
    counts = F.col("orb.orbit_id").isNull() | (F.col("element_orbit_id") == F.col("orb.orbit_id"))
    values = [*PROFILE_ELEMENTS, "element_equinox"]
    held = F.struct("snapshot_time", "obj", "orb")
    joined = joined.groupBy(*PIN).agg(F.first(held).alias("held"), *[F.max(F.when(counts, F.col(c))).alias(c) for c in values])
    joined = joined.select(*PIN, "held.*", *values)
    phys = pivot_values(physical, PIN, "param_name", "param_value_numeric", PHYSICAL_PARAMETERS)
    joined = joined.join(phys, PIN, "left")
    first_text = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit("")), b)
    return joined.select(
        "spkid", *[F.col(f"obj.{c}").alias(c) for c in OBJECT_FIELDS], "snapshot_key", "run_id", "snapshot_time",
        first_text("orb.orbit_id", "obj.object_orbit_id").alias("orbit_id"), F.col("orb.epoch_jd").alias("epoch_jd"),
        first_text("orb.equinox", "element_equinox").alias("equinox"),
        *[F.col(f"orb.{c}").alias(c) for c in ORBIT_FIELDS if c not in ("epoch_jd", "equinox")],
        *PROFILE_ELEMENTS,
        period_from_days(F.col("orbital_period_days")).alias("orbital_period_yr"),
        *PHYSICAL_PARAMETERS,
        quality_tier(F.col("orb.data_arc_days"), F.col("orb.n_obs_used"), F.col("orb.condition_code")).alias(
            "astrometric_data_quality_tier"),
    )


def catalog_profile(
    objects: DataFrame, orbits: DataFrame, elements: DataFrame, physical: DataFrame, bridge: DataFrame
) -> DataFrame:
    """One row per entity with a catalog snapshot; every value comes from that one snapshot."""
    profile = snapshot_profile(objects, orbits, elements, physical)
    joined = profile.join(preferred_pivot(bridge, CATALOG_FEED, "spkid"), "spkid", "inner")
    return joined.select("spkid", "asteroid_key", *[c for c in profile.columns if c != "spkid"])
