import json

import pytest
from pyspark.sql import functions as F

from helpers import bridge_rows, by, make, risk_rows
from perigee.operators.validation import validate_profiles, validate_world
from perigee.plans import adhoc, catalog, cross_source, dossier, sky, watchlist, world

AS_OF = "2026-09-27T00:00:00Z"
DAY = "2026-09-26"


def approach_table(spark, *rows):
    full = [{"closest_approach_date": "2026-09-28", "hazardous": False, "name": "n", **r} for r in rows]
    return make(spark, "asteroids", *full)


def parted(df):
    d = F.col("closest_approach_date")
    return df.withColumns({"year": F.substring(d, 1, 4), "month": F.substring(d, 6, 2), "day": F.substring(d, 9, 2)})


def catalog_tables(spark):
    head = dict(snapshot_key=DAY, run_id="r1", snapshot_time=f"{DAY}T00:00:00Z", spkid="S1")
    old = {**head, "snapshot_key": "2026-09-01", "run_id": "r0", "snapshot_time": "2026-09-01T00:00:00Z"}
    objects = make(spark, "fact_sbdb_object_snapshot", {**head, "designation": "D1", "fullname": "F1", "orbit_id": "14", "orbit_class_name": "Apollo", "is_neo": True},
                   {**old, "designation": "OLD", "fullname": "OLD", "orbit_id": "13"}, {**old, "spkid": "S2", "designation": "D2"})
    orbits = make(spark, "fact_sbdb_orbit", {**head, "orbit_id": "14", "data_arc_days": 3844, "n_obs_used": 150, "condition_code": "1", "equinox": "J2000"},
                  {**old, "orbit_id": "13", "data_arc_days": 1, "n_obs_used": 2, "condition_code": "9"})
    element = lambda n, v, h=head, o="14": {**h, "orbit_id": o, "element_name": n, "element_value": v, "equinox": "J2000"}
    elements = make(spark, "fact_sbdb_orbit_element", element("e", 0.452), element("a", 1.854), element("per", 730.5), element("om", 9.0, old, "13"), element("e", 0.9, old, "13"))
    par = lambda n, v, h=head: {**h, "param_name": n, "param_value_numeric": v}
    physical = make(spark, "fact_sbdb_physical_parameter", par("diameter", 0.85), par("H", 18.2), par("albedo", 0.18, old))
    return objects, orbits, elements, physical


def bridge(spark):
    return bridge_rows(
        spark, ("k1", "sbdb", "spkid", "S1"), ("k1", "neows", "id", "1"), ("k1", "sentry", "sentry_id", "s1"),
        ("k2", "sbdb", "spkid", "S2"), ("k2", "neows", "id", "2"), ("k2", "sentry", "sentry_id", "s2"), ("k2", "sentry", "sentry_id", "s3"),
        ("k3", "neows", "id", "3"), ("k3", "sentry", "sentry_id", "s9"), ("k4", "neows", "id", "4"), ("k5", "neows", "id", "4"))


def audit(spark, *rows):
    return make(spark, "fact_entity_resolution", *[
        dict(resolution_run_id="r", resolved_at=f"2026-09-2{i}", source_system="neows", identifier_name="id", source_identifier_value=r[0], match_state=r[1],
             match_rule=r[2], assigned_asteroid_key=r[3], evidence_json="{}") for i, r in enumerate(rows)])


def risk(spark):
    return risk_rows(spark, dict(sentry_id="s1", snapshot_key="2026-09-25", impact_probability=9e-6, impact_year_range="old"),
                     dict(sentry_id="s1", snapshot_key=DAY, impact_probability=2e-6), dict(sentry_id="s2", snapshot_key=DAY), dict(sentry_id="s3", snapshot_key="2026-09-25"))


def test_view_mixes_snapshots_and_profile_does_not(spark):
    tables = catalog_tables(spark)
    view = by(catalog.characterization_profile(*tables, bridge(spark)), "spkid")["S1"]
    assert view["eccentricity"] == 0.9 and view["albedo"] == 0.18  # maxima over all snapshots
    assert view["orbital_period_yr"] == pytest.approx(1.854**1.5) and view["astrometric_data_quality_tier"] == "ADEQUATELY_CONSTRAINED"
    got = by(catalog.catalog_profile(*tables, bridge(spark)), "asteroid_key")
    one = got["k1"]
    assert (one["snapshot_key"], one["eccentricity"], one["albedo"], one["ascending_node_longitude_deg"]) == (DAY, 0.452, None, None)
    assert one["orbital_period_yr"] == pytest.approx(2.0) and one["estimated_diameter_km"] == 0.85 and one["designation"] == "D1"
    assert got["k2"]["astrometric_data_quality_tier"] == "UNREPORTED" and got["k2"]["designation"] == "D2"
    assert set(got) == {"k1", "k2"}


def test_resolution_prefers_the_newest_audit_over_the_bridge(spark):
    ids = spark.createDataFrame([(i,) for i in ("1", "2", "3", "4", "5", "x1", "9")], "neows_id string")
    log = audit(spark, ("1", "RESOLVED", "OLD", "old"), ("1", "UNRESOLVED", None, None), ("2", "RESOLVED", "EXACT", "k2"), ("9", "AMBIGUOUS", "DUP", None), ("5", "RESOLVED", "R", None))
    got = {k: (v["match_state"], v["match_rule"], v["asteroid_key"]) for k, v in by(watchlist.resolve_ids(ids, log, bridge(spark)), "neows_id").items()}
    assert got == {
        "1": ("UNRESOLVED", "NO_CROSS_SOURCE_MATCH", None), "2": ("RESOLVED", "EXACT", "k2"), "3": ("RESOLVED", "BRIDGE_EXACT_NEOWS_ID", "k3"),
        "4": ("AMBIGUOUS", "BRIDGE_MULTIPLE_CANDIDATE_KEYS", None), "5": ("UNRESOLVED", "R", None), "x1": ("INVALID", "INVALID_SYNTAX", None),
        "9": ("AMBIGUOUS", "DUP", None)}


def test_three_meanings_of_linked(spark):
    rows = approach_table(spark, dict(id="1", miss_distance_km=5e6), dict(id="2", miss_distance_km=4e6), dict(id="3", miss_distance_km=3e6), dict(id="8", miss_distance_km=1e6))
    objects, orbits, elements, physical = catalog_tables(spark)
    view = by(watchlist.threat_watchlist_view(parted(rows), risk(spark), objects, orbits, elements, physical, bridge(spark), AS_OF), "neows_id")
    served = by(watchlist.threat_watchlist(rows, risk(spark), objects, bridge(spark), audit(spark)), "neows_id")
    flat = by(world.world_snapshot(rows, risk(spark), objects, orbits, bridge(spark), audit(spark)), "neows_id")
    # k3 has a risk id without risk rows: the view does not monitor it, the served list does, the world links it without a record.
    assert [view["3"]["is_sentry_monitored"], served["3"]["is_sentry_monitored"], flat["3"]["sentry_link_count"]] == [False, True, 1]
    assert flat["3"]["sentry_id"] == "s9" and flat["3"]["sentry_snapshot_key"] is None
    assert view["1"]["sentry_impact_probability"] == served["1"]["sentry_impact_probability"] == flat["1"]["sentry_impact_probability"] == 2e-6
    assert view["1"]["sentry_all_time_max_impact_probability"] == 9e-6 and view["1"]["sentry_impact_year_range"] == "2061-2094"
    # Two risk ids: latest scalars are withheld, maxima are not.
    assert view["2"]["is_sentry_ambiguous"] and view["2"]["sentry_id"] is None and view["2"]["sentry_all_time_max_impact_probability"] == 1e-6
    assert served["2"]["sentry_impact_probability"] is None and flat["2"]["sentry_id"] is None and flat["2"]["sentry_link_count"] == 2
    assert served["8"]["match_state"] == "UNRESOLVED" and not served["8"]["has_sbdb_characterization"] and view["8"]["sbdb_astrometric_quality_tier"] == "UNREPORTED"
    assert view["1"]["sbdb_spkid"] == "S1" and served["1"]["sbdb_fullname"] == "F1" and view["1"]["miss_distance_lunar"] == 5e6 / 384400.0


def test_copies_of_an_approach(spark):
    rows = approach_table(spark, dict(id="1", miss_distance_km=9.0, name="far"), dict(id="1", miss_distance_km=5.0, name="near"))
    served = watchlist.threat_watchlist(rows, risk(spark), catalog_tables(spark)[0], bridge(spark), audit(spark)).collect()
    assert [(r.name, r.miss_distance_km) for r in served] == [("near", 5.0)]
    parts = parted(rows).withColumn("day", F.when(F.col("name") == "far", "29").otherwise("28"))
    from perigee.operators.picking import newest_partition

    assert [r.name for r in newest_partition(parts).collect()] == ["far"]


def test_watchlist_page(spark):
    rows = approach_table(spark, *[dict(id=str(i), miss_distance_km=i * 1e6, hazardous=[True, False, None][i % 3]) for i in range(1, 10)])
    served = watchlist.threat_watchlist(rows, risk(spark), catalog_tables(spark)[0], bridge(spark), audit(spark))
    page, figures = watchlist.watchlist_page(served, 2, 1, horizon_mkm=6)
    assert [r.neows_id for r in page.collect()] == ["2", "3"]
    assert figures.first().asDict() == dict(total=6, limit=2, offset=1, returned=2)
    assert {r.neows_id for r in watchlist.filter_watchlist(served, hazardous=False).collect()} == {"1", "4", "7"}
    assert {r.neows_id for r in watchlist.filter_watchlist(served, sentry_monitored=True).collect()} == {"1", "2", "3"}
    for bad in (dict(limit=0), dict(limit=501), dict(offset=-1)):
        with pytest.raises(ValueError):
            watchlist.watchlist_page(served, **bad)


@pytest.mark.parametrize("offset", [0, 1, 37, 495, 999, 1000, 5000])
def test_pages_of_any_depth(spark, offset):
    from perigee.operators.tallying import page

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b")).repartition(7)
    rows, total = page(df, ["a", "b"], 10, offset)
    assert [r.a for r in rows.collect()] == list(range(offset, min(offset + 10, 1000))) and total.first().total == 1000


def test_cross_source_profile(spark):
    rows = approach_table(spark, dict(id="1", miss_distance_km=5e6, hazardous=None), dict(id="1", miss_distance_km=4e6, hazardous=True, closest_approach_date="2026-10-01"))
    got = by(cross_source.cross_source_profile(rows, risk(spark), *catalog_tables(spark), bridge(spark), AS_OF), "asteroid_key")
    one, two, three = got["k1"], got["k2"], got["k3"]
    assert one["neows_total_approaches_recorded"] == 2 and one["neows_min_miss_distance_km"] == 4e6 and one["is_classified_hazardous_neows"]
    assert one["sentry_total_snapshots_observed"] == 2 and one["sentry_is_currently_active"] and one["canonical_designation"] == "D1"
    assert two["is_sentry_ambiguous"] and two["sentry_id"] is None and two["has_sentry_monitoring"] and not two["has_neows_telemetry"]
    assert not three["has_sbdb_characterization"] and not three["has_sentry_monitoring"] and three["sbdb_astrometric_quality_tier"] == "UNREPORTED"


def test_coverage_audit_reads_the_newest_run_only(spark):
    rows = [dict(resolution_run_id=r, resolved_at=t, source_system="neows", identifier_name="id", source_identifier_value=v, match_state=s, match_rule="R", assigned_asteroid_key=k)
            for r, t, v, s, k in (("old", "1", "a", "RESOLVED", "k1"), ("new", "2", "a", "RESOLVED", "k1"), ("new", "2", "b", "RESOLVED", "k1"), ("new", "2", "c", "UNRESOLVED", None))]
    got = by(cross_source.crosswalk_coverage_audit(make(spark, "fact_entity_resolution", *rows)), "match_state")
    assert got["RESOLVED"]["evaluation_count"] == 2 and got["RESOLVED"]["pct_of_source_system"] == 66.6667
    assert got["RESOLVED"]["resolved_to_canonical_key_count"] == 1 and got["UNRESOLVED"]["total_source_system_evaluations"] == 3


def test_risk_profile_withholds_everything_when_ambiguous(spark):
    got = by(dossier.risk_profile(risk(spark), bridge(spark)), "asteroid_key")
    assert got["k1"]["latest_impact_probability"] == 2e-6 and got["k1"]["all_time_max_impact_probability"] == 9e-6 and got["k1"]["is_currently_active"]
    assert got["k2"]["sentry_identifier_count"] == 2 and got["k2"]["all_time_max_impact_probability"] is None and got["k2"]["total_snapshots_observed"] == 0
    assert got["k3"]["has_sentry_monitoring"] and got["k3"]["sentry_id"] == "s9" and got["k3"]["latest_snapshot_key"] is None
    assert got["k4"]["has_sentry_monitoring"] is False and got["k4"]["is_currently_active"] is False


@pytest.fixture(scope="module")
def profile_inputs(spark):
    rows = approach_table(spark, dict(id="1", miss_distance_km=5e6, is_sentry_object=True), dict(id="2", miss_distance_km=4e6), dict(id="8", miss_distance_km=1e6), dict(id="3", miss_distance_km=2e6))
    objects, orbits, elements, physical = catalog_tables(spark)
    return rows, risk(spark), objects, orbits, elements, physical, bridge(spark), audit(spark)


def test_unified_profile(spark, profile_inputs):
    got = by(dossier.unified_profile(*profile_inputs), "neows_id")
    one, two, lost, linked = got["1"], got["2"], got["8"], got["3"]
    assert one["sentry"]["status"] == "available" and one["sentry"]["in_latest_catalog"] and one["sentry"]["assessment"]["impact_probability"] == 2e-6
    assert one["identity"]["availability"]["status"] == "available" and one["orbit"]["availability"]["unavailable"]["aphelion_distance_au"] == "not_in_source"
    assert one["provenance"]["sbdb"]["snapshot_key"] == DAY and one["sentry"]["assessment_endpoint"] == "/asteroids/1/sentry"
    assert two["sentry"]["status"] == "ambiguous" and two["identity"]["availability"]["unavailable"]["sentry_id"] == "ambiguous_linkage"
    assert set(two["sentry"]["assessment"]["availability"]["unavailable"].values()) == {"ambiguous_linkage"}
    assert lost["identity"]["availability"]["status"] == "unavailable" and set(lost["orbit"]["availability"]["unavailable"].values()) == {"not_resolved"}
    assert linked["sentry"]["status"] == "linked_no_record" and linked["identity"]["sentry_id"] == "s9"
    rows, *rest = profile_inputs
    older = by(dossier.unified_profile(rows.drop("relative_velocity_km_s"), *rest), "neows_id")["1"]
    assert older["encounter"]["availability"]["unavailable"]["relative_velocity_km_s"] == "not_in_current_contract"
    assert older["encounter"]["availability"]["unavailable"]["close_approach_datetime"] == "not_in_source"
    assert dossier.unified_profile(*profile_inputs, neows_id="2").count() == 1


def test_answers(spark, profile_inputs):
    rows, rsk, objects, orbits, elements, physical, links, log = profile_inputs
    cat = by(dossier.catalog_answers(rows, log, links, objects, orbits, elements, physical), "neows_id")
    assert cat["1"]["data"]["spkid"] == "S1" and cat["8"]["data"] is None and cat["8"]["evidence"]
    risks = by(dossier.risk_answers(rows, log, links, rsk), "neows_id")
    assert risks["8"]["data"] is None and risks["2"]["data"]["is_sentry_ambiguous"]
    history = by(dossier.history_answers(rows, log, links, rsk), "neows_id")
    assert [history[i]["snapshots"] for i in ("1", "2", "8", "3")] == [2, None, None, 0] and history["2"]["warning"]
    assert dossier.history_rows(dossier.history_answers(rows, log, links, rsk), rsk).count() == 2
    ids = [(r.neows_id, r.identifier_value) for r in dossier.crosswalk_answers(rows, log, links).collect()]
    assert ("8", None) in ids and len([i for i in ids if i[0] == "1"]) == 3
    first = dossier.crosswalk(links, "k1").collect()
    assert [r.is_primary_pivot for r in first] == [True, False, False]
    twice = rows.unionByName(rows.withColumn("closest_approach_date", F.lit("2027-01-01"))).unionByName(rows.withColumn("miss_distance_km", F.lit(9e9)))
    detail = by(dossier.asteroid_detail(twice, rsk, objects, links, log), "neows_id")
    assert detail["1"]["approaches_recorded_count"] == 2 and detail["1"]["closest_approach_date"] == "2026-09-28"
    assert detail["1"]["miss_distance_km"] == 5e6 and detail["1"]["sentry_id"] == "s1" and detail["1"]["sbdb_fullname"] == "F1"
    assert detail["2"]["is_sentry_ambiguous"] and detail["8"]["match_state"] == "UNRESOLVED" and set(detail) == {"1", "2", "3", "8"}
    assert dossier.asteroid_detail(twice, rsk, objects, links, log, neows_id="2").count() == 1


def reads(df):
    """How often a plan reads each stored table, by the name of its folder."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    paths = [leaves.apply(i).relation().location().rootPaths().mkString(",").rsplit("/", 1)[1] for i in range(leaves.size())]
    return {p: paths.count(p) for p in paths}


def test_facts_are_read_once(spark, profile_inputs, tmp_path):
    names = ["approaches", "risk", "objects", "orbits", "elements", "physical", "bridge", "audit"]
    for name, table in zip(names, profile_inputs):
        table.write.parquet(f"{tmp_path}/{name}")
    approaches, risk_table, objects, orbits, elements, physical, links, log = stored = [spark.read.parquet(f"{tmp_path}/{n}") for n in names]
    profile = reads(dossier.unified_profile(*stored))
    assert {n: profile[n] for n in ("approaches", "objects", "orbits", "elements", "physical")} == dict.fromkeys(("approaches", "objects", "orbits", "elements", "physical"), 1)
    assert profile["risk"] <= 2
    catalog_reads = reads(catalog.catalog_profile(objects, orbits, elements, physical, links))
    assert {n: catalog_reads[n] for n in ("objects", "orbits", "elements", "physical")} == dict.fromkeys(("objects", "orbits", "elements", "physical"), 1)
    detail = reads(dossier.asteroid_detail(approaches, risk_table, objects, links, log))
    assert (detail["approaches"], detail["objects"], detail.get("risk", 0)) == (1, 1, 0)  # no risk value is asked for


def as_json(df):
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record_json"))


def test_validation_accepts_what_the_plans_produce(spark, profile_inputs):
    rows, rsk, objects, orbits, elements, physical, links, log = profile_inputs
    records = as_json(world.world_records(world.world_snapshot(rows, rsk, objects, orbits, links, log)))
    assert {r.reason for r in validate_world(records).collect()} == {None}
    profiles = as_json(dossier.unified_profile(*profile_inputs))
    assert {r.reason for r in validate_profiles(profiles).collect()} == {None}

    good = json.loads(records.first().record_json)
    changes = {
        "neows_id: no id": {"neows_id": "01"}, "name: no text": {"name": ""}, "asteroid_key: no string": {"asteroid_key": 5},
        "encounter: no object": {"encounter": None}, "encounter.miss_distance_km: no positive": {"encounter": {**good["encounter"], "miss_distance_km": 0}},
        "encounter.is_potentially_hazardous: no boolean": {"encounter": {**good["encounter"], "is_potentially_hazardous": "no"}},
        "encounter.relative_velocity_km_s: no number": {"encounter": {**good["encounter"], "relative_velocity_km_s": "1"}},
        "resolution.match_state: unknown value": {"resolution": {"match_state": "MAYBE"}}, "sbdb.status: unknown value": {"sbdb": {"status": "x"}},
        "illustrative_direction: no unit vector": {"illustrative_direction": {"x": 1, "y": 1, "z": 0}}}
    sent = [json.dumps({**good, "neows_id": f"9{i}", **c}) for i, c in enumerate(changes.values())] + [json.dumps(good)] * 2 + ["[1]"]
    out = validate_world(spark.createDataFrame([(s,) for s in sent], "record_json string")).collect()
    assert sorted(r.reason for r in out) == sorted([*changes, "neows_id: repeated", "neows_id: repeated", "record: no object"])


def test_responses_are_judged_on_two_levels(spark, profile_inputs):
    from perigee.operators.validation import validate_responses
    from perigee.sources.sinks import RUN_TABLE_DDL, dataset_lineage

    rows, rsk, objects, orbits, elements, physical, links, log = profile_inputs
    flat = world.world_snapshot(rows, rsk, objects, orbits, links, log)
    runs = spark.createDataFrame([("asteroids", "r1", "2026-01-01", "neows", "a.json", "aa"), ("asteroids", "r2", "2026-02-01", "neows", "b.json", "bb"), ("other", "r3", "2027", "x", None, None)], RUN_TABLE_DDL)
    info = world.world_info(flat, ["x"], dataset_lineage(runs))
    assert info.first().neows.asDict() == dict(dataset_run_id="r2", source_raw_file="b.json", source_raw_sha256="bb")
    assert world.world_info(flat, []).first().neows is None
    assert by(dossier.unified_profile(*profile_inputs, lineage=dataset_lineage(runs)), "neows_id")["1"]["provenance"]["neows"]["dataset_run_id"] == "r2"
    head = json.loads(world.world_envelope(info).first().world_json)
    good = [json.loads(r.record_json) for r in as_json(world.world_records(flat)).collect()]
    spatial = head["spatial_model"]
    sent = {
        "fine": {"world": head, "data": good}, "empty": {"world": head, "data": []}, "twice": {"world": head, "data": [*good, good[0], {**good[1], "name": ""}, 5, None]},
        "data: no list": {"world": head, "data": {}}, "world: no object": {"data": good}, "response: no object": [good], "world.object_count: no integer": {"world": {**head, "object_count": 1.5}, "data": good},
        "world.spatial_model.direction_algorithm: not supported": {"world": {**head, "spatial_model": {**spatial, "direction_algorithm": "v0"}}, "data": good},
        "world.spatial_model.note: no string": {"world": {**head, "spatial_model": {**spatial, "note": None}}, "data": good},
        "world.neows_fields_not_in_dataset: no list": {"world": {**head, "neows_fields_not_in_dataset": "x"}, "data": good}}
    frame = spark.createDataFrame([(k, json.dumps(v)) for k, v in sent.items()] + [("cut", '{"world":')], "response_id string, response_json string")
    envelopes, records = validate_responses(frame)
    got = by(envelopes, "response_id")
    assert {k: v["envelope_reason"] for k, v in got.items()} == {**{k: k if ":" in k else None for k in sent}, "cut": "response: no object"}
    assert got["fine"]["received"] == len(good) and got["data: no list"]["received"] == got["empty"]["received"] == got["cut"]["received"] == 0
    reasons = {}
    for r in records.collect():
        reasons.setdefault(r.response_id, []).append((r.position, r.reason))
    assert {r for _, r in reasons["fine"]} == {None}
    n = len(good)
    assert dict(reasons["twice"]) == {**{i: None for i in range(n)}, 0: "neows_id: repeated", n: "neows_id: repeated", n + 1: "name: no text", n + 2: "record: no object", n + 3: "record: no object"}
    assert {r for _, r in reasons["world: no object"]} == {"envelope: world: no object"} and "cut" not in reasons


def test_sky(spark):
    rows = spark.createDataFrame([("1", 5e5), ("2", 2.5e6), ("3", 1.2e8)], "neows_id string, miss_distance_km double")
    assert sky.distance_domain(rows).first().max_km == 1.3e8
    assert [r.neows_id for r in sky.reveal_order(rows).collect()] == ["1", "2", "3"]
    counts = {r.progress: r.revealed for r in sky.reveal_counts(rows, [0.0, 0.22, 0.5, 1.0]).collect()}
    assert counts == {0.0: 0, 0.22: 1, 0.5: 2, 1.0: 3}
    bands = by(sky.band_counts(rows), "band")
    assert len(bands) == 130 and bands[2]["objects"] == 1 and bands[10]["tier"] == "major"
    assert [r.band for r in sky.bands_between(sky.distance_domain(rows), 1.5e6, 4.2e6).collect()] == [2, 3, 4]


def test_adhoc_partition_filters_prune(spark, tmp_path):
    rows = approach_table(spark, *[dict(id=str(i), miss_distance_km=float(i), closest_approach_date=f"2026-09-{10 + i}", hazardous=i % 2 == 0) for i in range(10)])
    from perigee.sources.sinks import publish
    from perigee.sources.tables import read_partitioned

    publish(rows, str(tmp_path / "t"), F.col("closest_approach_date"))
    stored = read_partitioned(spark, str(tmp_path / "t"), "asteroids")
    week = adhoc.hazardous_in_range(stored, "2026", "09", "12", "15")
    assert [r.id for r in week.collect()] == ["2", "4"]
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "TakeOrderedAndProject" in plan
    assert adhoc.monthly_summary(stored, "2026", "09").count() == 2
    assert stored.schema["month"].dataType.simpleString() == "string" and stored.first().month == "09"


def test_a_section_is_looked_up_once(spark, profile_inputs):
    profiles = as_json(dossier.unified_profile(*profile_inputs))
    judged = validate_profiles(profiles.limit(1))._jdf.queryExecution().optimizedPlan().toString()
    # One look-up a section, three an availability block and a few for the whole; not one or two for every field.
    assert judged.count("variant_get(") < 50

    good = json.loads(profiles.first().record_json)
    wrong = {
        "orbit: no object": {**good, "orbit": [1]}, "physical.albedo: no number": {**good, "physical": {**good["physical"], "albedo": "0.1"}},
        "orbit.eccentricity: no number": {**good, "orbit": {k: v for k, v in good["orbit"].items() if k != "eccentricity"}},
        "sentry.assessment.torino_scale_max: no integer": {**good, "sentry": {**good["sentry"], "assessment": {**good["sentry"]["assessment"], "torino_scale_max": 1.5}}},
        "identity.availability: unknown value": {**good, "identity": {**good["identity"], "availability": None}},
        "physical.availability: unknown reason": {**good, "physical": {**good["physical"], "availability": {"status": "partial", "unavailable": {"albedo": "?"}}}}}
    whole = {**good, "sentry": {**good["sentry"], "assessment": {**good["sentry"]["assessment"], "torino_scale_max": 2.0}}}
    sent = spark.createDataFrame([(json.dumps(r),) for r in [*wrong.values(), whole]], "record_json string")
    assert [r.reason for r in validate_profiles(sent).collect()] == [*wrong, None]


def test_rows_of_an_object_are_dealt_out_once(spark, profile_inputs):
    _, _, objects, orbits, elements, physical, links, _ = profile_inputs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_object = [elements.repartition("spkid"), physical.repartition("spkid")]
        plan = catalog.snapshot_profile(objects, orbits, *by_object)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(shuffles) == 3 and all("hashpartitioning(spkid" in line for line in shuffles)
