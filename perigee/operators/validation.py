"""Validation of fetched JSON records: accepted, or rejected with one reason; never repaired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.functions.text import is_number, is_object, leaf_text
from perigee.runtime import attach, materialize, pinned

UNIT_TOLERANCE = 1e-6
ID_DIGITS = r"^[1-9][0-9]*$"
CATALOG_STATUSES = [V.AVAILABLE, V.NOT_RESOLVED, V.NOT_PRESENT]
RISK_STATUSES = [V.AVAILABLE, V.NOT_RESOLVED, V.NOT_PRESENT, V.LINK_AMBIGUOUS, V.LINKED_NO_RECORD]

# The profile fields that are shown, by section and kind; names as served.
PROFILE_FIELDS = {
    "identity": {
        "name": "string", "neows_id": "string", "match_state": "string", "sbdb_spkid": "string",
        "sbdb_designation": "string", "sentry_id": "string"},
    "encounter": {
        "close_approach_datetime": "string", "closest_approach_date": "string", "miss_distance_km": "number",
        "relative_velocity_km_s": "number", "is_potentially_hazardous": "boolean", "is_sentry_object": "boolean"},
    "neows_physical": {
        "absolute_magnitude_h": "number", "estimated_diameter_min_km": "number", "estimated_diameter_max_km": "number"},
    "orbit": {
        "orbit_class_name": "string", "semi_major_axis_au": "number", "eccentricity": "number",
        "inclination_deg": "number", "ascending_node_longitude_deg": "number", "argument_of_perihelion_deg": "number",
        "mean_anomaly_deg": "number", "perihelion_distance_au": "number", "aphelion_distance_au": "number",
        "orbital_period_days": "number", "epoch_jd": "number", "is_pha": "boolean"},
    "physical": {
        "absolute_magnitude": "number", "estimated_diameter_km": "number", "albedo": "number", "rotational_period_hr": "number"},
    "sentry.assessment": {
        "impact_probability": "number", "potential_impacts_count": "integer", "impact_year_range": "string",
        "palermo_scale_cum": "number", "palermo_scale_max": "number", "torino_scale_max": "integer",
        "v_infinity_km_s": "number", "last_obs_date": "string"},
}


def _kind(record: Column, path: str) -> Column:
    """JSON type at a path; VOID for an explicit null, NULL when the key is absent."""
    return F.schema_of_variant(F.try_variant_get(record, path, "variant"))


def _fits(value: Column, kind: str, nullable: bool) -> Column:
    """Whether a VARIANT is of a kind; an absent one (NULL) is not."""
    found = F.schema_of_variant(value)
    if kind == "number":
        good = is_number(found)
    elif kind == "integer":
        text = leaf_text(value, "$")
        good = (found == "BIGINT") | (is_number(found) & (text.try_cast("double") == F.floor(text.try_cast("double"))))
    else:
        good = found == kind.upper()
    if nullable:
        good = good | (found == "VOID")
    return F.coalesce(good, F.lit(False))


def _is(record: Column, path: str, kind: str, nullable: bool) -> Column:
    return _fits(F.try_variant_get(record, path, "variant"), kind, nullable)


def _double(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "double")


# What is judged in a world record: (path, kind, null allowed). The blocks come first, as their fields
# mean nothing without them.
WORLD_RULES = [
    ("encounter", "object", False), ("illustrative_direction", "object", False),
    ("neows_id", "id", False), ("name", "text", False), ("asteroid_key", "string", True),
    ("resolution.match_state", V.MATCH_STATES, False), ("sbdb.status", CATALOG_STATUSES, False), ("sentry.status", RISK_STATUSES, False),
    ("sentry.in_latest_catalog", "boolean", True),
    ("encounter.closest_approach_date", "string", False), ("encounter.close_approach_datetime", "string", True),
    ("encounter.miss_distance_km", "positive", False), ("encounter.is_potentially_hazardous", "boolean", True),
    ("encounter.relative_velocity_km_s", "number", True), ("encounter.estimated_diameter_min_km", "number", True),
    ("encounter.estimated_diameter_max_km", "number", True),
    *[(f"illustrative_direction.{c}", "number", False) for c in "xyz"],
]


def _meets(record: Column, path: str, kind: str | list[str], nullable: bool) -> Column:
    """Whether one field is as a rule says."""
    place = f"$.{path}"
    if isinstance(kind, list):
        good = leaf_text(record, place).isin(kind)
    elif kind == "object":
        good = is_object(record, place)
    elif kind == "id":
        good = _is(record, place, "string", False) & leaf_text(record, place).rlike(ID_DIGITS)
    elif kind == "text":
        good = _is(record, place, "string", False) & (leaf_text(record, place) != "")
    elif kind == "positive":
        good = _is(record, place, "number", False) & (_double(record, place) > 0)
    else:
        good = _is(record, place, kind, nullable)
    return F.coalesce(good, F.lit(False))


def _code(path: str, kind: str | list[str]) -> str:
    return f"{path}: {'unknown value' if isinstance(kind, list) else 'no ' + kind}"


def world_defect(record: Column) -> Column:
    """Code of the first rule that a world record breaks, NULL for a sound one."""
    whole = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    reason = F.when(~whole, "record: no object")
    for path, kind, nullable in WORLD_RULES:
        reason = reason.when(~_meets(record, path, kind, nullable), _code(path, kind))
    length = F.sqrt(sum((F.pow(_double(record, f"$.illustrative_direction.{c}"), F.lit(2)) for c in "xyz"), F.lit(0.0)))
    return reason.when(F.abs(length - 1.0) > UNIT_TOLERANCE, "illustrative_direction: no unit vector")


# What is judged in the header of a world response, in this order.
HEADER_RULES = [
    ("world", "object", False), ("world.spatial_model", "object", False),
    ("world.spatial_model.direction_semantics", [V.DIRECTION_SEMANTICS], False), ("world.spatial_model.direction_algorithm", "string", False),
    ("world.spatial_model.note", "string", False), ("world.neows", "object", False), ("world.object_count", "integer", False),
]


def envelope_defect(response: Column, algorithms: list[str]) -> Column:
    """Code of what is wrong with a world response as a whole, NULL for a sound one: its list, its header, or
    a direction algorithm that isn't one of `algorithms`."""
    is_list = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(response, path, "variant")).startswith("ARRAY"), F.lit(False))
    whole = F.coalesce(F.schema_of_variant(response).startswith("OBJECT"), F.lit(False))
    reason = F.when(~whole, "response: no object").when(~is_list("$.data"), "data: no list")
    for path, kind, nullable in HEADER_RULES:
        reason = reason.when(~_meets(response, path, kind, nullable), _code(path, kind))
    reason = reason.when(~is_list("$.world.neows_fields_not_in_dataset"), "world.neows_fields_not_in_dataset: no list")
    known = F.coalesce(leaf_text(response, "$.world.spatial_model.direction_algorithm").isin(algorithms), F.lit(False))
    return reason.when(~known, "world.spatial_model.direction_algorithm: not supported")


def validate_responses(
    responses: DataFrame, key: str = "response_id", text: str = "response_json", algorithms: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """World responses judged on two levels: (envelopes, records).

    Envelopes are (`key`, envelope_reason, received), one row per response. Records are (`key`, position,
    neows_id, reason), one row per record of a response with a list: a refused envelope refuses all its
    records by its own reason; in a sound one each record is judged, and all copies of an id that
    repeats within the response are refused. Nothing is repaired. Each response is parsed once, into a
    written table that both levels are made of.
    """
    supported = algorithms if algorithms is not None else [V.DIRECTION_ALGORITHM]
    parsed = pinned(responses.select(key, text), r=F.try_parse_json(text))
    listed = F.try_variant_get("r", "$.data", "array<variant>")
    judged = pinned(parsed, envelope_reason=envelope_defect(F.col("r"), supported), items=listed).drop(text, "r")
    exploded = judged.select(key, "envelope_reason", F.posexplode_outer("items").alias("position", "record"))
    is_record = F.col("position").isNotNull()
    ident = F.when(_kind(F.col("record"), "$.neows_id") == "STRING", leaf_text(F.col("record"), "$.neows_id"))
    own = F.when(is_record, F.coalesce(F.concat(F.lit("envelope: "), "envelope_reason"), world_defect(F.col("record"))))
    rows = materialize(exploded.select(key, "envelope_reason", "position", ident.alias("neows_id"), own.alias("reason")), "judged-responses")
    envelopes = rows.groupBy(key).agg(F.first("envelope_reason").alias("envelope_reason"), F.count("position").alias("received"))
    records = rows.filter("position IS NOT NULL").drop("envelope_reason")
    sound = records.filter(F.col("reason").isNull())
    repeated = sound.groupBy(key, "neows_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(key, "neows_id", F.lit(True).alias("repeated"))
    joined = records.join(repeated, [key, "neows_id"], "left")
    twice = F.col("reason").isNull() & F.coalesce("repeated", F.lit(False))
    return envelopes, joined.select(key, "position", "neows_id", F.when(twice, "neows_id: repeated").otherwise(F.col("reason")).alias("reason"))


def validate_world(records: DataFrame, text: str = "record_json") -> DataFrame:
    """Every record with its id and `reason` (NULL when accepted); all copies of a repeated id are refused."""
    parsed = pinned(records, r=F.try_parse_json(text))
    ident = F.when(_kind(F.col("r"), "$.neows_id") == "STRING", leaf_text(F.col("r"), "$.neows_id"))
    judged = pinned(parsed, neows_id=ident, reason=world_defect(F.col("r"))).drop("r")
    sound = judged.filter(F.col("reason").isNull())
    repeated = sound.groupBy("neows_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(
        F.col("neows_id").alias("repeated_id"))
    joined = attach(judged, repeated, "neows_id", "repeated_id", spread=[text])
    twice = F.col("reason").isNull() & F.col("repeated_id").isNotNull()
    return joined.withColumn("reason", F.when(twice, "neows_id: repeated").otherwise(F.col("reason"))).drop("repeated_id")


def profile_sections(record: Column) -> dict[str, Column]:
    """The sections of a profile as maps, NULL where a section is no object.

    Every path is looked up from the root of the record; a map holds all fields of a section after one pass.
    """
    return {f"held_{s.replace('.', '_')}": F.try_variant_get(record, f"$.{s}", "map<string, variant>") for s in PROFILE_FIELDS}


def profile_defect(record: Column, sections: dict[str, Column]) -> Column:
    """Reason a profile is unusable: any displayed field of the wrong kind fails all of it.

    `sections` are the values of `profile_sections`.
    """
    reason = F.when(~_is(record, "$.neows_id", "string", False), "neows_id: no string")
    for (section, fields), held in zip(PROFILE_FIELDS.items(), sections.values(), strict=True):
        reason = reason.when(held.isNull(), f"{section}: no object")
        for name, kind in fields.items():
            reason = reason.when(~_fits(held[name], kind, True), f"{section}.{name}: no {kind}")
        block = held["availability"]
        given = block.isNotNull()
        known = F.coalesce(leaf_text(block, "$.status").isin(V.AVAILABLE, V.PARTIAL, V.UNAVAILABLE), F.lit(False))
        reasons = F.map_values(F.try_variant_get(block, "$.unavailable", "map<string, string>"))
        listed = F.coalesce(F.forall(reasons, lambda r: F.coalesce(r.isin(V.UNAVAILABLE_REASONS), F.lit(False))), F.lit(False))
        reason = reason.when(given & ~(known & is_object(block, "$.unavailable")), f"{section}.availability: unknown value")
        reason = reason.when(given & ~listed, f"{section}.availability: unknown reason")
    return (
        reason.when(~(_is(record, "$.sentry.status", "string", False) & _is(record, "$.sentry.source_contract", "string", False)
                      & is_object(record, "$.provenance")), "sentry: no status, contract or provenance")
    )


def validate_profiles(records: DataFrame, text: str = "record_json") -> DataFrame:
    parsed = pinned(records, r=F.try_parse_json(text))
    sections = profile_sections(F.col("r"))
    judged = pinned(pinned(parsed, **sections), reason=profile_defect(F.col("r"), {name: F.col(name) for name in sections}))
    return judged.drop("r", *sections)
