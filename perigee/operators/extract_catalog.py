"""Object documents to the four catalog tables.

A document is judged as a whole, inside its own row: the element and parameter lists of one object
are a few entries, so array functions check them and no shuffle is needed until targets that
reached the same object are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.functions.numbers import to_bigint, to_double
from perigee.functions.text import blank_to_null, is_object, leaf_kind, squeeze, strip
from perigee.runtime import attach, materialize, pinned
from perigee.schemas import table_columns

DOCUMENT_TEXT = (
    "code string, object struct<spkid: string, des: string, fullname: string, shortname: string, kind: string, prefix: string, "
    "orbit_id: string, orbit_class: struct<code: string, name: string>, des_alt: string>, "
    "orbit struct<orbit_id: string, epoch: string, equinox: string, soln_date: string, source: string, producer: string, "
    "first_obs: string, last_obs: string, data_arc: string, n_obs_used: string, condition_code: string, rms: string, "
    "moid: string, moid_jup: string, t_jup: string, pe_used: string, sb_used: string, elements: array<string>>, "
    "phys_par array<string>"
)
DOCUMENT_FLAGS = "object struct<neo: boolean, pha: boolean>"
ELEMENT = "name string, value string, sigma string, units string, title string, label string"
PARAMETER = "name string, value string, sigma string, units string, ref string, notes string, title string, `desc` string"


def alternates(listed: Column, designation: Column) -> Column:
    """Every text of a `des_alt` list, squeezed, distinct in order, without the own designation.

    NULL when the list was not captured, empty when the source lists none.
    """
    value = F.try_parse_json(listed)
    entries = F.try_variant_get(value, "$", "array<variant>")

    def texts(entry: Column) -> Column:
        kind = F.schema_of_variant(entry)
        inner = F.map_values(F.try_variant_get(entry, "$", "map<string, variant>"))
        values = F.when(kind.startswith("OBJECT"), inner).otherwise(F.array(entry))
        strings = F.filter(values, lambda v: F.schema_of_variant(v) == "STRING")
        return F.transform(strings, lambda v: squeeze(F.try_variant_get(v, "$", "string")))

    named = F.filter(F.flatten(F.transform(entries, texts)), lambda t: (t != "") & (t != designation))
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), F.array_distinct(named))


def document_fields(t: Column, flags: Column) -> dict[str, Column]:
    obj, orb = t["object"], t["orbit"]
    designation = strip(obj["des"])
    text_or = lambda c, default: F.coalesce(strip(c), F.lit(default))
    filled_or = lambda c, default: F.coalesce(blank_to_null(c), F.lit(default))
    # An explicit JSON null counts as absent.
    return {
        "spkid": strip(obj["spkid"]),
        "designation": designation,
        "fullname": F.coalesce(blank_to_null(obj["fullname"]), designation),
        "shortname": blank_to_null(obj["shortname"]),
        "object_kind": filled_or(obj["kind"], "unknown"),
        "is_neo": flags["object"]["neo"],
        "is_pha": flags["object"]["pha"],
        "orbit_class_code": strip(obj["orbit_class"]["code"]),
        "orbit_class_name": strip(obj["orbit_class"]["name"]),
        "object_orbit_id": strip(obj["orbit_id"]),
        "prefix": blank_to_null(obj["prefix"]),
        "alternate_designations": alternates(obj["des_alt"], designation),
        "orbit_id": strip(orb["orbit_id"]),
        "epoch_jd": to_double(orb["epoch"]),
        "equinox": strip(orb["equinox"]),
        "soln_date": text_or(orb["soln_date"], ""),
        "orbit_source": filled_or(orb["source"], "JPL"),
        "producer": blank_to_null(orb["producer"]),
        "first_obs": text_or(orb["first_obs"], ""),
        "last_obs": text_or(orb["last_obs"], ""),
        "data_arc_days": to_bigint(orb["data_arc"]),
        "n_obs_used": to_bigint(orb["n_obs_used"]),
        "condition_code": filled_or(orb["condition_code"], "unknown"),
        "rms": to_double(orb["rms"]),
        "earth_moid_au": to_double(orb["moid"]),
        "jupiter_moid_au": to_double(orb["moid_jup"]),
        "t_jup": to_double(orb["t_jup"]),
        "pe_used": blank_to_null(orb["pe_used"]),
        "sb_used": blank_to_null(orb["sb_used"]),
        # Entries that are no objects parse to structs without a name, which later steps skip.
        "elements": F.transform(orb["elements"], lambda e: F.from_json(e, ELEMENT)),
        "parameters": F.transform(t["phys_par"], lambda p: F.from_json(p, PARAMETER)),
    }


def _element_rows(elements: Column) -> Column:
    usable = F.filter(elements, lambda e: (e["name"] != "") & to_double(e["value"]).isNotNull())
    return F.transform(usable, lambda e: F.struct(
        strip(e["name"]).alias("element_name"), to_double(e["value"]).alias("element_value"),
        to_double(e["sigma"]).alias("sigma"), blank_to_null(e["units"]).alias("units"),
        blank_to_null(e["title"]).alias("title"), blank_to_null(e["label"]).alias("label")))


def _parameter_rows(parameters: Column) -> Column:
    usable = F.filter(parameters, lambda p: blank_to_null(p["name"]).isNotNull() & p["value"].isNotNull())
    return F.transform(usable, lambda p: F.struct(
        strip(p["name"]).alias("param_name"), to_double(p["value"]).alias("param_value_numeric"),
        strip(p["value"]).alias("param_value_raw"), to_double(p["sigma"]).alias("sigma"),
        blank_to_null(p["units"]).alias("units"), blank_to_null(p["ref"]).alias("bib_reference"),
        blank_to_null(p["notes"]).alias("notes"), blank_to_null(p["title"]).alias("title"),
        blank_to_null(p["desc"]).alias("desc")))


def _absent(column: str) -> Column:
    return ~F.coalesce(F.col(column) != "", F.lit(False))


def _below(column: str, minimum: float, strict: bool = False) -> Column:
    value = F.col(column)
    return ~F.coalesce(value > minimum if strict else value >= minimum, F.lit(False))


def judge_documents(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Fields of every document, `object_defect` (identity unusable) and `defect` (anything unusable).

    The document is parsed once as text leaves, once for its flags, and once as VARIANT for the few
    questions about JSON types.
    """
    parsed = pinned(
        documents, t=F.from_json(payload, DOCUMENT_TEXT), flags=F.from_json(payload, DOCUMENT_FLAGS), doc=F.try_parse_json(payload))
    doc = F.col("doc")
    asked = {
        "is_root": F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False)),
        "is_several": F.coalesce(F.col("t.code") == "300", F.lit(False)) | leaf_kind(doc, "$.list").isNotNull(),
        "has_object": is_object(doc, "$.object"), "has_orbit": is_object(doc, "$.orbit"),
        "spkid_text": F.coalesce(leaf_kind(doc, "$.object.spkid") == "STRING", F.lit(False)),
        "des_text": F.coalesce(leaf_kind(doc, "$.object.des") == "STRING", F.lit(False)),
        "parameters_listed": F.coalesce(leaf_kind(doc, "$.phys_par").startswith("ARRAY"), F.lit(True)),
    }
    fielded = pinned(parsed, **document_fields(F.col("t"), F.col("flags")), **asked).drop(payload, "t", "flags", "doc")
    refused = (
        F.when(~F.col("is_root"), "not_an_object").when(F.col("is_several"), "several_matches")
        .when(~F.col("has_object"), "no_object_section").when(~F.col("has_orbit"), "no_orbit_section")
    )
    identity = (
        F.when(refused.isNotNull(), refused)
        .when(_absent("spkid") | ~F.col("spkid_text"), "missing_spkid")
        .when(_absent("designation") | ~F.col("des_text"), "missing_designation")
        .when(_absent("orbit_class_code") | _absent("orbit_class_name"), "missing_orbit_class")
        .when(_absent("object_orbit_id"), "missing_orbit_id")
    )
    names = F.filter(F.transform("parameters", lambda p: strip(p["name"])), lambda n: n != "")
    negative = F.exists("elements", lambda e: (e["name"] == "e") & (to_double(e["value"]) < 0))
    listed = F.coalesce(F.size("elements") > 0, F.lit(False))
    body = (
        F.when(_absent("orbit_id"), "orbit_without_id").when(_below("epoch_jd", 0.0, strict=True), "invalid_epoch")
        .when(_absent("equinox"), "missing_equinox").when(_below("n_obs_used", 0), "invalid_n_obs_used")
        .when(_below("rms", 0.0), "invalid_rms").when(_below("earth_moid_au", 0.0), "invalid_earth_moid")
        .when(~listed, "no_elements").when(F.coalesce(negative, F.lit(False)), "negative_eccentricity")
        .when(~F.col("parameters_listed"), "parameters_not_a_list")
        .when(F.coalesce(F.size(F.array_distinct(names)) < F.size(names), F.lit(False)), "duplicate_parameter")
    )
    judged = pinned(fielded, object_defect=identity)
    return pinned(judged, defect=F.coalesce("object_defect", body)).drop(*asked)


def classify_targets(documents: DataFrame, scope: list[str]) -> DataFrame:
    """Status per target of a run (`scope`): success, duplicate or failed.

    Targets are taken in sorted order: the first sound document of an object succeeds, later targets
    of that object are duplicates, and broken documents before it have failed. Documents are judged once,
    into a written table that the winners and the targets are both made of.
    """
    judged = judge_documents(documents)
    identified = F.when(F.col("object_defect").isNull(), F.to_json(F.struct(*scope, "spkid")))
    judged = materialize(judged.withColumn("object_in_run", identified), "judged-documents")
    winner = judged.filter(F.col("defect").isNull()).groupBy("object_in_run").agg(F.min("target").alias("winner"))
    winner = winner.withColumnRenamed("object_in_run", "won")
    joined = attach(judged, winner, "object_in_run", "won", spread=["target"])
    status = (
        F.when(F.col("object_defect").isNotNull() | F.col("winner").isNull() | (F.col("target") < F.col("winner")), "failed")
        .when(F.col("target") == F.col("winner"), "success").otherwise("duplicate")
    )
    return joined.withColumn("status", status).drop("won", "winner", "object_in_run")


def object_rows(classified: DataFrame) -> DataFrame:
    kept = classified.filter("status = 'success'").drop("orbit_id").withColumnRenamed("object_orbit_id", "orbit_id")
    return kept.select(*table_columns("fact_sbdb_object_snapshot"))


def orbit_rows(classified: DataFrame) -> DataFrame:
    return classified.filter("status = 'success'").select(*table_columns("fact_sbdb_orbit"))


def element_rows(classified: DataFrame) -> DataFrame:
    # Elements are filed under the orbit id of the object section.
    rows = classified.filter("status = 'success'").select(
        "snapshot_key", "run_id", "snapshot_time", "spkid", F.col("object_orbit_id").alias("orbit_id"), "epoch_jd", "equinox",
        F.explode(_element_rows(F.col("elements"))).alias("e"))
    return rows.select("*", "e.*").drop("e").select(*table_columns("fact_sbdb_orbit_element"))


def parameter_rows(classified: DataFrame) -> DataFrame:
    rows = classified.filter("status = 'success'").select(
        "snapshot_key", "run_id", "snapshot_time", "spkid", F.explode(_parameter_rows(F.col("parameters"))).alias("p"))
    return rows.select("*", "p.*").drop("p").select(*table_columns("fact_sbdb_physical_parameter"))


def batch_tally(classified: DataFrame, scope: list[str]) -> DataFrame:
    """Per run: targets, successes, failures, duplicates."""
    of = lambda s: F.count_if(F.col("status") == s)
    return classified.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("total_targets"), of("success").alias("successful_targets_count"),
        of("failed").alias("failed_targets_count"), of("duplicate").alias("duplicate_targets_count"))
