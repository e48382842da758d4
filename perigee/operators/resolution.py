"""Deterministic entity resolution: catalog hub, approach feed and risk feed to one crosswalk.

Every rule is a join against one row per alias, so a designation shared by a third of the hub still
costs one row. The final collapse works on (identifier, key) pairs and then on identifiers; both
are aggregates with map-side combine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee import vocabulary as V
from perigee.functions.keys import entity_key
from perigee.functions.text import blank_to_null, normalize_designation
from perigee.runtime import attach, materialize, pinned

# Evidence gives the number of candidates. The candidates themselves are rows: `links` leads from an
# identifier to an alias or to its competing keys, and `candidates` from an alias to its objects, so an
# alias shared by many objects and named by many identifiers is listed once.
COMPETING = "COMPETING_KEYS"

# Texts stored in the evidence; fixed values.
NO_CATALOG_ID = "Missing or empty SBDB SPK-ID"
NO_APPROACH_ID = "Missing or empty NeoWs asteroid ID"
NO_RISK_ID = "Missing or empty Sentry ID"
NO_RISK_DESIGNATION = "Missing or empty Sentry designation"
CONTRADICTORY = "NeoWs ID and designation point to contradictory SBDB objects"
APPROACH_COLLISION = "NeoWs designation matches multiple SBDB entities"
APPROACH_UNMATCHED = "NeoWs ID and designation not found in SBDB catalog"
RISK_COLLISION = "Sentry designation matches multiple SBDB entities"
RISK_ID_COLLISION = "Sentry ID associated with ambiguous designation"
RISK_UNMATCHED = "Designation not found in SBDB catalog"
RISK_ID_UNMATCHED = "Associated with unresolved Sentry designation"
COMPETING_KEYS = "Source identifier mapped to multiple competing asteroid_keys"


@dataclass(frozen=True)
class Crosswalk:
    """`identifiers` has one row per (source_system, identifier_name, value) and feeds bridge and audit.

    `links` has one row per ambiguous identifier and alias or competing key; `candidates` has one per
    (alias, object).
    """

    identifiers: DataFrame
    candidates: DataFrame
    links: DataFrame

    @property
    def bridge(self) -> DataFrame:
        return bridge_of(self.identifiers)

    @property
    def audit(self) -> DataFrame:
        return audit_of(self.identifiers)


def evidence(**entries: Column) -> Column:
    """Compact JSON with sorted keys; NULL entries are left out."""
    return F.to_json(F.struct(*[entries[k].alias(k) for k in sorted(entries)]))


def hub_entities(catalog: DataFrame) -> DataFrame:
    """Distinct catalog identities with cleaned fields; `spkid` is NULL for an unusable row."""
    raw = catalog.select("spkid", "designation", "fullname").distinct()
    return raw.select(
        F.col("spkid").alias("raw_spkid"),
        blank_to_null(F.col("spkid")).alias("spkid"),
        blank_to_null(F.col("designation")).alias("designation"),
        blank_to_null(F.col("fullname")).alias("fullname"),
    )


def hub_aliases(catalog: DataFrame, hub: DataFrame) -> DataFrame:
    """(alias, spkid) pairs of the hub: how the pair arises and the designation it carries.

    Alternates of all copies of an identity count, so the result does not depend on input order.
    """
    # Each entity is one `des` row; the number of entities behind an alias is what makes it ambiguous.
    named = hub.filter(F.col("spkid").isNotNull()).select(
        "spkid", "designation",
        F.inline(F.array(
            F.struct(F.lit("des").alias("field"), normalize_designation(F.col("designation")).alias("alias")),
            F.struct(F.lit("fullname").alias("field"), normalize_designation(F.col("fullname")).alias("alias")),
        )),
    )
    listed = catalog.select("spkid", "designation", F.explode("alternate_designations").alias("listed")).distinct()
    alternate = pinned(
        listed, id=blank_to_null(F.col("spkid")), own=blank_to_null(F.col("designation")),
        alias=normalize_designation(F.col("listed")), own_alias=normalize_designation(F.col("designation")),
    ).filter(F.col("id").isNotNull() & (F.col("alias") != F.col("own_alias"))).select(
        F.col("id").alias("spkid"), F.col("own").alias("designation"), F.lit("alternate").alias("field"), "alias")
    pairs = named.unionByName(alternate).filter((F.col("alias") != ""))
    count = lambda field: F.count_if(F.col("field") == field)
    return pairs.groupBy("alias", "spkid").agg(
        count("des").alias("des_entities"),
        F.max(F.when(F.col("field") == "des", F.col("designation"))).alias("des_designation"),
        (count("fullname") > 0).alias("by_fullname"),
        (count("alternate") > 0).alias("by_alternate"),
        F.max(F.when(F.col("field") != "des", F.col("designation"))).alias("other_designation"),
    )


def alias_index(pairs: DataFrame) -> DataFrame:
    """One row per alias: candidate counts and the sole candidate."""
    is_des, is_other = F.col("des_entities") > 0, F.col("by_fullname") | F.col("by_alternate")
    return pairs.groupBy("alias").agg(
        F.sum("des_entities").alias("des_count"),
        F.min(F.when(is_des, F.col("spkid"))).alias("des_first"),
        F.max(F.when(is_des, F.col("spkid"))).alias("des_last"),
        F.max("des_designation").alias("des_designation"),
        F.count_if(is_other).alias("other_count"),
        F.max(F.when(is_other, F.col("spkid"))).alias("other_spkid"),
        F.max("other_designation").alias("other_designation"),
        F.max("by_fullname").alias("other_by_fullname"),
    )


def _audit_row(system: Column | str, name: str, value: Column, state: str, rule: Column | str, proof: Column,
               target: Column | None = None, target_name: str | None = None, spkid: Column | None = None,
               alias: Column | None = None) -> Column:
    """One audit row as a struct; `spkid` is the matched object of a resolved row, `alias` leads to the
    candidates of an ambiguous one."""
    text = F.lit(None).cast("string")
    matched = target is not None
    return F.struct(
        F.lit(system).alias("source_system"),
        F.lit(name).alias("identifier_name"),
        value.alias("source_identifier_value"),
        (F.lit(V.CATALOG_FEED) if matched else text).alias("matched_target_system"),
        (F.lit(target_name) if matched else text).alias("matched_target_identifier_name"),
        (target if matched else text).alias("matched_target_identifier_value"),
        (spkid if spkid is not None else text).alias("matched_spkid"),
        (alias if alias is not None else text).alias("candidates_alias"),
        F.lit(state).alias("match_state"),
        (rule if isinstance(rule, Column) else F.lit(rule)).alias("match_rule"),
        proof.alias("evidence_json"),
    )


def _expand(df: DataFrame, *rows: Column) -> DataFrame:
    """The given rows of each input row, without the NULL ones."""
    return df.select(F.inline(F.array_compact(F.array(*rows))))


def catalog_audit(hub: DataFrame) -> DataFrame:
    """One or two rows per identity: the pivot (or why there is none) and the designation."""
    spk, des, full = F.col("spkid"), F.col("designation"), F.col("fullname")
    invalid = _audit_row(
        V.CATALOG_FEED, "spkid", F.coalesce("raw_spkid", F.lit("")), V.INVALID, V.INVALID_IDENTIFIER,
        evidence(error=F.lit(NO_CATALOG_ID)))
    pivot = _audit_row(
        V.CATALOG_FEED, "spkid", spk, V.RESOLVED, V.PIVOT,
        evidence(pivot=F.lit("canonical_external_pivot"), spkid=spk, fullname=full), spk, "spkid", spk)
    named = _audit_row(
        V.CATALOG_FEED, "des", des, V.RESOLVED, V.CATALOG_DESIGNATION,
        evidence(associated_with_spkid=spk, fullname=full), spk, "spkid", spk)
    sound = spk.isNotNull()
    return _expand(hub, F.when(sound, pivot).otherwise(invalid), F.when(sound & des.isNotNull(), named))


def approach_audit(approaches: DataFrame, hub: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per distinct (id, name): by id, else by designation, else by full name and alternates."""
    feed = approaches.select(F.col("id").alias("raw_id"), "name").distinct().select(
        "raw_id", blank_to_null(F.col("raw_id")).alias("id"), blank_to_null(F.col("name")).alias("name"),
        F.nullif(normalize_designation(F.col("name")), F.lit("")).alias("alias"))
    ident, name, alias = F.col("id"), F.col("name"), F.col("alias")

    # An spkid listed under two designations (or under one and none) cannot be matched directly.
    label = F.coalesce("designation", F.lit("\u0000"))
    direct = (
        hub.filter(F.col("spkid").isNotNull()).groupBy("spkid")
        .agg((F.min(label) == F.max(label)).alias("is_consistent"))
        .filter("is_consistent").select(F.col("spkid").alias("direct_spkid"))
    )
    found = attach(feed, direct, "id", "direct_spkid", spread=["raw_id", "name"])
    found = attach(found, aliases.withColumnRenamed("alias", "hub_alias"), "alias", "hub_alias", spread=["raw_id"])

    is_direct = F.col("direct_spkid").isNotNull()
    des_count = F.coalesce("des_count", F.lit(0))
    other_count = F.coalesce("other_count", F.lit(0))
    names_another = (des_count > 0) & ((F.col("des_first") != ident) | (F.col("des_last") != ident))
    use_des = des_count > 0
    total = F.when(use_des, des_count).otherwise(other_count)
    field = F.when(use_des, F.lit(None)).when(F.col("other_by_fullname"), "fullname").otherwise("alternate_designation")
    rule = (
        F.when(use_des, V.EXACT_DESIGNATION).when(F.col("other_by_fullname"), V.EXACT_FULLNAME)
        .otherwise(V.ALTERNATE_DESIGNATION)
    )
    matched = F.when(use_des, F.col("des_first")).otherwise(F.col("other_spkid"))
    matched_des = F.when(use_des, F.col("des_designation")).otherwise(F.col("other_designation"))
    invalid = _audit_row(
        V.APPROACH_FEED, "id", F.coalesce("raw_id", F.lit("")), V.INVALID, V.INVALID_IDENTIFIER,
        evidence(error=F.lit(NO_APPROACH_ID)))
    contradiction = _audit_row(
        V.APPROACH_FEED, "id", ident, V.AMBIGUOUS, V.CONTRADICTION,
        evidence(error=F.lit(CONTRADICTORY), id_spkid=ident, name=name, normalized_designation=alias, candidate_count=des_count),
        ident, "spkid", alias=alias)
    direct_row = _audit_row(
        V.APPROACH_FEED, "id", ident, V.RESOLVED, V.EXACT_SPKID,
        evidence(matched_spkid=ident, pivot_match=F.lit("exact_spkid"), name=name), ident, "spkid", ident)
    sole = _audit_row(
        V.APPROACH_FEED, "id", ident, V.RESOLVED, rule,
        evidence(matched_sbdb_des=matched_des, matched_spkid=matched, name=name, normalized_designation=alias,
                 resolution_rule=rule, matched_sbdb_field=field),
        matched_des, "des", matched)
    several = _audit_row(
        V.APPROACH_FEED, "id", ident, V.AMBIGUOUS, V.COLLISION,
        evidence(error=F.lit(APPROACH_COLLISION), name=name, normalized_designation=alias, matched_sbdb_field=field,
                 candidate_count=total),
        alias, "des", alias=alias)
    nothing = _audit_row(
        V.APPROACH_FEED, "id", ident, V.UNRESOLVED, V.NO_MATCH,
        evidence(reason=F.lit(APPROACH_UNMATCHED), name=name, normalized_designation=alias))
    row = (
        F.when(ident.isNull(), invalid).when(is_direct & names_another, contradiction).when(is_direct, direct_row)
        .when(total == 1, sole).when(total > 1, several).otherwise(nothing)
    )
    return _expand(found, row)


def risk_audit(risk: DataFrame, aliases: DataFrame) -> DataFrame:
    """Two rows per distinct risk object, by designation alone; one if an identifier is missing."""
    feed = risk.select("sentry_id", "designation", "fullname").distinct().select(
        F.col("sentry_id").alias("raw_id"), F.col("designation").alias("raw_des"),
        blank_to_null(F.col("sentry_id")).alias("sentry_id"), blank_to_null(F.col("designation")).alias("des"),
        blank_to_null(F.col("fullname")).alias("fullname"))
    feed = feed.withColumn("alias", F.nullif(normalize_designation(F.col("des")), F.lit("")))
    ident, des, full = F.col("sentry_id"), F.col("des"), F.col("fullname")
    no_id = F.array(_audit_row(
        V.RISK_FEED, "sentry_id", F.coalesce("raw_id", F.lit("")), V.INVALID, V.INVALID_IDENTIFIER,
        evidence(error=F.lit(NO_RISK_ID))))
    no_des = F.array(_audit_row(
        V.RISK_FEED, "des", F.coalesce("raw_des", F.lit("")), V.INVALID, V.INVALID_IDENTIFIER,
        evidence(error=F.lit(NO_RISK_DESIGNATION))))
    found = attach(feed, aliases.withColumnRenamed("alias", "hub_alias"), "alias", "hub_alias", spread=["raw_id"])
    count = F.coalesce("des_count", F.lit(0))
    matched, matched_des = F.col("des_first"), F.coalesce("des_designation", "des")

    sole = F.array(
        _audit_row(V.RISK_FEED, "des", des, V.RESOLVED, V.EXACT_DESIGNATION,
                   evidence(matched_sbdb_des=matched_des, matched_spkid=matched, normalized_designation=F.col("alias"),
                            fullname=full), matched_des, "des", matched),
        _audit_row(V.RISK_FEED, "sentry_id", ident, V.RESOLVED, V.RISK_ID_BY_DESIGNATION,
                   evidence(associated_via_sentry_des=des, matched_spkid=matched, fullname=full),
                   matched_des, "des", matched),
    )
    several = F.array(
        _audit_row(V.RISK_FEED, "des", des, V.AMBIGUOUS, V.COLLISION,
                   evidence(error=F.lit(RISK_COLLISION), normalized_designation=F.col("alias"), fullname=full,
                            candidate_count=count), des, "des", alias=F.col("alias")),
        _audit_row(V.RISK_FEED, "sentry_id", ident, V.AMBIGUOUS, V.COLLISION,
                   evidence(error=F.lit(RISK_ID_COLLISION), normalized_designation=F.col("alias"), fullname=full,
                            candidate_count=count), des, "des", alias=F.col("alias")),
    )
    nothing = F.array(
        _audit_row(V.RISK_FEED, "des", des, V.UNRESOLVED, V.NO_MATCH,
                   evidence(reason=F.lit(RISK_UNMATCHED), normalized=F.coalesce("alias", F.lit("")), fullname=full)),
        _audit_row(V.RISK_FEED, "sentry_id", ident, V.UNRESOLVED, V.NO_MATCH,
                   evidence(reason=F.lit(RISK_ID_UNMATCHED), designation=des, fullname=full)),
    )
    rows = (
        F.when(ident.isNull(), no_id).when(des.isNull(), no_des)
        .when(count == 1, sole).when(count > 1, several).otherwise(nothing)
    )
    return found.select(F.inline(rows))


IDENTIFIER = ["source_system", "identifier_name", "source_identifier_value"]


def evaluated_pairs(evaluations: DataFrame) -> DataFrame:
    """One row per identifier and matched object, or alias of its candidates, with the most conservative verdict.

    Objects go by their short ids; the keys made of them are computed where rows are published.
    """
    severity = F.create_map(*[F.lit(x) for kv in V.STATE_SEVERITY.items() for x in kv])
    verdict = F.struct(
        severity[F.col("match_state")].alias("severity"), "match_state", "match_rule", "matched_target_system",
        "matched_target_identifier_name", "matched_target_identifier_value", "evidence_json",
    )
    return evaluations.groupBy(*IDENTIFIER, "matched_spkid", "candidates_alias").agg(F.max(verdict).alias("verdict"))


def collapse(pairs: DataFrame, run_id: str, resolved_at: str) -> DataFrame:
    """One row per identifier: the most conservative evaluation, and its single object if it has one.

    An identifier that reached two keys is quarantined: no bridge row, and an AMBIGUOUS audit.
    """
    joined = pairs.groupBy(*IDENTIFIER).agg(
        F.count("matched_spkid").alias("key_count"), F.min("matched_spkid").alias("first_spkid"), F.max("verdict").alias("v"))
    clash = F.col("key_count") > 1
    v = F.col("v")
    state = F.when(clash, V.AMBIGUOUS).otherwise(v["match_state"])
    return joined.select(
        F.lit(run_id).alias("resolution_run_id"),
        F.lit(resolved_at).alias("resolved_at"),
        *IDENTIFIER,
        v["matched_target_system"].alias("matched_target_system"),
        v["matched_target_identifier_name"].alias("matched_target_identifier_name"),
        v["matched_target_identifier_value"].alias("matched_target_identifier_value"),
        state.alias("match_state"),
        F.when(clash, V.COLLISION).otherwise(v["match_rule"]).alias("match_rule"),
        F.when(clash, evidence(error=F.lit(COMPETING_KEYS), candidate_count=F.col("key_count")))
        .otherwise(v["evidence_json"]).alias("evidence_json"),
        F.when(F.col("key_count") == 1, F.col("first_spkid")).alias("sole_spkid"),
    )


def candidate_links(pairs: DataFrame) -> DataFrame:
    """Where the candidates of ambiguous identifiers are: under an alias, or the competing keys themselves."""
    by_alias = pairs.filter(F.col("candidates_alias").isNotNull()).select(
        *IDENTIFIER, F.col("verdict.match_rule").alias("kind"), F.col("candidates_alias").alias("alias"), F.lit(None).cast("string").alias("candidate_key"))
    keyed = pairs.filter(F.col("matched_spkid").isNotNull())
    several = keyed.groupBy(*IDENTIFIER).agg(F.count("matched_spkid").alias("n")).filter("n > 1").drop("n")
    competing = keyed.join(several, IDENTIFIER, "left_semi").select(
        *IDENTIFIER, F.lit(COMPETING).alias("kind"), F.lit(None).cast("string").alias("alias"), entity_key(F.col("matched_spkid")).alias("candidate_key"))
    return by_alias.unionByName(competing)


def bridge_of(identifiers: DataFrame) -> DataFrame:
    is_pivot = (F.col("source_system") == V.CATALOG_FEED) & (F.col("identifier_name") == "spkid")
    return identifiers.filter(F.col("sole_spkid").isNotNull()).select(
        entity_key(F.col("sole_spkid")).alias("asteroid_key"), "source_system", "identifier_name",
        F.col("source_identifier_value").alias("identifier_value"), is_pivot.alias("is_primary_pivot"),
        F.col("resolved_at").alias("created_at"), F.col("resolved_at").alias("updated_at"),
    )


def audit_of(identifiers: DataFrame) -> DataFrame:
    assigned = F.when(F.col("match_state") == V.RESOLVED, entity_key(F.col("sole_spkid")))
    return identifiers.withColumn("assigned_asteroid_key", assigned).drop("sole_spkid")


BRIDGE_ORDER = ["asteroid_key", "source_system", "identifier_name", "identifier_value"]


def resolve(approaches: DataFrame, catalog: DataFrame, risk: DataFrame, run_id: str, resolved_at: str) -> Crosswalk:
    """Resolve the three feeds. Reads id/name, spkid/designation/fullname/alternate_designations and
    sentry_id/designation/fullname; anything else in the inputs is pruned away. Intermediate tables
    are written to the shared folder, so this runs jobs; the final collapse stays lazy."""
    # The hub, its aliases and their index are each read several times; written once, they cost two
    # reads of the catalog and the joins know their sizes.
    hub = materialize(hub_entities(catalog), "hub")
    pairs = materialize(hub_aliases(catalog, hub), "aliases")
    aliases = materialize(alias_index(pairs), "alias-index")
    evaluations = (
        catalog_audit(hub)
        .unionByName(approach_audit(approaches, hub, aliases))
        .unionByName(risk_audit(risk, aliases))
    )
    candidates = pairs.select("alias", "spkid", entity_key(F.col("spkid")).alias("asteroid_key"),
                              "des_entities", "by_fullname", "by_alternate")
    evaluated = materialize(evaluated_pairs(evaluations), "evaluations")
    return Crosswalk(collapse(evaluated, run_id, resolved_at), candidates, candidate_links(evaluated))


def resolution_metrics(audit: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row: totals by state, resolved share, and bridge size."""
    state = lambda s: F.count_if(F.col("match_state") == s)
    totals = audit.agg(
        F.count(F.lit(1)).alias("total_evaluated"), state(V.RESOLVED).alias("resolved_count"),
        state(V.UNRESOLVED).alias("unresolved_count"), state(V.AMBIGUOUS).alias("ambiguous_count"),
        state(V.INVALID).alias("invalid_count"))
    rate = F.when(F.col("total_evaluated") > 0, F.round(F.col("resolved_count") / F.col("total_evaluated") * 100.0, 2))
    emitted = F.broadcast(bridge.agg(F.count(F.lit(1)).alias("bridge_records_emitted")))
    return totals.withColumn("resolution_rate_pct", F.coalesce(rate, F.lit(0.0))).crossJoin(emitted)


def metrics_breakdown(audit: DataFrame) -> DataFrame:
    """Counts by source, by state and by rule, as (dimension, value, evaluations).

    The three dimensions are folded out of one pass over (source, state, rule) groups.
    """
    cells = audit.groupBy("source_system", "match_state", "match_rule").agg(F.count(F.lit(1)).alias("n"))
    long = cells.select("n", F.explode(F.create_map(
        F.lit("source"), F.col("source_system"), F.lit("state"), F.col("match_state"), F.lit("rule"), F.col("match_rule"),
    )).alias("dimension", "value"))
    return long.groupBy("dimension", "value").agg(F.sum("n").alias("evaluations"))
