import json

import pytest
from pyspark.sql import functions as F

from helpers import by
from perigee.operators import extract_approaches as A
from perigee.operators import extract_catalog as C
from perigee.operators import extract_risk as K
from perigee.plans.quality import approach_gate, catalog_gate, risk_gate
from perigee.sources.raw import approach_records, risk_records

GONE = object()


def approach(**change):
    near = {"close_approach_date": "2026-09-29", "close_approach_date_full": "2026-Sep-29 07:18", "epoch_date_close_approach": 1790666280000,
            "miss_distance": {"kilometers": "100.5"}, "relative_velocity": {"kilometers_per_second": "12.5"}}
    rec = {"id": "1", "name": "(A)", "is_potentially_hazardous_asteroid": False, "is_sentry_object": True, "absolute_magnitude_h": 21.5,
           "estimated_diameter": {"kilometers": {"estimated_diameter_min": 0.1, "estimated_diameter_max": 0.2}}, "close_approach_data": [near]}
    for k, v in change.items():
        target = near if k in near else rec
        if v is GONE:
            target.pop(k)
        else:
            target[k] = v
    return rec


def extract(spark, *records, **dates):
    doc = json.dumps({"near_earth_objects": dates or {"2026-09-29": list(records)}})
    return approach_records(spark.createDataFrame([("f", doc)], "source_file string, payload string"))


def test_sound_record(spark):
    row = A.accepted_approaches(extract(spark, approach()), ["source_file"]).first().asDict()
    assert row == dict(
        source_file="f", id="1", name="(A)", closest_approach_date="2026-09-29", miss_distance_km=100.5, hazardous=False,
        close_approach_datetime="2026-09-29T07:18", close_approach_epoch_ms=1790666280000, relative_velocity_km_s=12.5,
        absolute_magnitude_h=21.5, estimated_diameter_min_km=0.1, estimated_diameter_max_km=0.2, is_sentry_object=True)


@pytest.mark.parametrize("change,reason", [
    (dict(id=GONE), "missing_id"), (dict(id=""), "missing_id"), (dict(name=None), "missing_name"), (dict(close_approach_data=[]), "missing_approach"),
    (dict(close_approach_data=GONE), "missing_approach"), (dict(close_approach_date=GONE), "missing_date"), (dict(close_approach_date="2026-02-30"), "invalid_date"),
    (dict(close_approach_date="2026-9-1"), "invalid_date"), (dict(miss_distance=GONE), "missing_distance"), (dict(miss_distance={}), "missing_distance"),
    (dict(miss_distance={"kilometers": "abc"}), "invalid_distance"), (dict(miss_distance={"kilometers": "nan"}), "invalid_distance"),
    (dict(miss_distance={"kilometers": "-1"}), "distance_not_positive"), (dict(is_potentially_hazardous_asteroid="true"), "hazard_flag_not_boolean"),
    (dict(is_potentially_hazardous_asteroid=1), "hazard_flag_not_boolean"), (dict(is_potentially_hazardous_asteroid=GONE), "hazard_flag_not_boolean"),
    (dict(id=GONE, name=GONE), "missing_id"),
])
def test_rejections(spark, change, reason):
    got = A.classified_approaches(extract(spark, approach(**change)), ["source_file"]).first()
    assert got.reject_reason == reason


def test_malformed_optionals_keep_the_row(spark):
    rec = approach(close_approach_date_full="soon", epoch_date_close_approach="1", relative_velocity={"kilometers_per_second": "0"}, absolute_magnitude_h=True,
                   estimated_diameter={"kilometers": {"estimated_diameter_min": 0.3, "estimated_diameter_max": 0.2}}, is_sentry_object="no")
    row = A.accepted_approaches(extract(spark, rec), ["source_file"]).first()
    assert [row[c] for c in ("close_approach_datetime", "close_approach_epoch_ms", "relative_velocity_km_s", "absolute_magnitude_h",
                             "estimated_diameter_min_km", "estimated_diameter_max_km", "is_sentry_object")] == [None] * 7


def test_first_copy_in_file_order_wins(spark):
    # Dates out of order in the file: the file decides, not the calendar.
    days = {"2026-09-30": [approach(name="first")], "2026-09-29": [approach(name="second"), approach(name="third", close_approach_date="2026-10-01")]}
    records = extract(spark, **days)
    assert {r.name for r in A.accepted_approaches(records, ["source_file"]).collect()} == {"first", "third"}
    tally = A.approach_tally(records, ["source_file"]).first()
    assert (tally.records_received, tally.valid_records, tally.skipped_records) == (3, 2, 1)


def test_gate_is_strict_at_twenty_percent(spark):
    good = [approach(id=str(i)) for i in range(4)]
    gate = approach_gate(A.approach_tally(extract(spark, *good, approach(id="")), ["source_file"])).first()
    assert gate.rejection_pct == 20.0 and not gate.gate_passed
    assert approach_gate(A.approach_tally(extract(spark, *good), ["source_file"])).first().gate_passed


def risk(**change):
    rec = {"id": "x31Q07T", "des": "2031 QT7", "fullname": "(2031 QT7)", "range": "2061-2094", "last_obs": "2031-08-19", "last_obs_jd": "2463099.25",
           "ip": "4.5e-05", "n_imp": "12", "ps_cum": "-4.25", "ps_max": "-4.5", "ts_max": "0", "v_inf": "11.5", "h": "22.125", "diameter": "0.125"}
    rec.update(change)
    return {k: v for k, v in rec.items() if v is not GONE}


def risk_frame(spark, *records):
    return risk_records(spark.createDataFrame(
        [("2026-09-27", "r", "2026-09-27T00:00:00Z", json.dumps({"data": list(records)}))],
        "snapshot_key string, run_id string, snapshot_time string, payload string"))


SCOPE = ["snapshot_key", "run_id", "snapshot_time"]


@pytest.mark.parametrize("change,reason", [
    (dict(), None), (dict(ip="0"), "impact_probability"), (dict(ip="1"), None), (dict(ip="1.01"), "impact_probability"), (dict(n_imp="0"), "potential_impacts_count"),
    (dict(n_imp=7), None), (dict(n_imp="5.5"), "potential_impacts_count"), (dict(ps_max=GONE), "palermo_scale"), (dict(ts_max="-1"), "torino_scale"),
    (dict(v_inf="-0.1"), "v_infinity"), (dict(last_obs="1979-12"), "last_obs"), (dict(h=""), None), (dict(h="x"), "absolute_magnitude"), (dict(diameter="?"), "estimated_diameter"),
    (dict(last_obs_jd="jd"), "last_obs_jd"), (dict(id=" "), "missing_identifier"), (dict(des=GONE), "missing_identifier"),
])
def test_risk_bounds(spark, change, reason):
    assert K.classified_risk(risk_frame(spark, risk(**change)), SCOPE).first().reject_reason == reason


def test_risk_rows(spark):
    frame = risk_frame(spark, risk(fullname=GONE, range=GONE, h=" "), risk(des="later copy"), "junk", risk(id="2", n_imp=7.9))
    rows = by(K.accepted_risk(frame, SCOPE), "sentry_id")
    first = rows["x31Q07T"]
    assert (first["fullname"], first["impact_year_range"], first["absolute_magnitude"], first["snapshot_key"]) == ("2031 QT7", "", None, "2026-09-27")
    assert rows["2"]["potential_impacts_count"] == 7 and len(rows) == 2
    gate = risk_gate(K.risk_tally(frame, SCOPE)).first()
    assert (gate.records_received, gate.valid_records, gate.status) == (4, 2, "WARNING")
    assert risk_gate(K.risk_tally(risk_frame(spark, risk(ip="0")), SCOPE)).first().status == "FAILED"


def document(**change):
    doc = {"object": {"spkid": "20900007", "des": "900007", "fullname": "900007 (2031 QT7)", "kind": "an", "neo": True, "pha": False, "orbit_id": "88",
                      "orbit_class": {"code": "APO", "name": "Apollo"}, "des_alt": [{"pri": "2031  QT7"}, {"des": "900007"}, "plain", {"n": 5}]},
           "orbit": {"orbit_id": "88", "epoch": "2461000.5", "equinox": "J2000", "n_obs_used": 406, "rms": ".37", "moid": ".08", "moid_jup": None, "data_arc": "9145",
                     "elements": [{"name": "e", "value": ".333", "sigma": "1e-9"}, {"name": "a", "value": "x"}, {"value": "1"}, 5]},
           "phys_par": [{"name": "H", "value": "19.6"}, {"name": "extent", "value": "1x2"}, {"name": "albedo", "value": None}]}
    for path, v in change.items():
        *parents, leaf = path.split("__")
        node = doc
        for p in parents:
            node = node[p]
        if v is GONE:
            node.pop(leaf)
        else:
            node[leaf] = v
    return doc


def targets(spark, **docs):
    rows = [("2026-10-02", "r", "t", name, doc if isinstance(doc, str) else json.dumps(doc)) for name, doc in docs.items()]
    return C.classify_targets(spark.createDataFrame(rows, "snapshot_key string, run_id string, snapshot_time string, target string, payload string"), SCOPE)


def test_document_tables(spark):
    c = targets(spark, a=document())
    obj, orb = C.object_rows(c).first(), C.orbit_rows(c).first()
    assert obj.alternate_designations == ["2031 QT7", "plain"] and obj.is_neo is True and obj.shortname is None
    assert (orb.condition_code, orb.orbit_source, orb.soln_date, orb.jupiter_moid_au, orb.n_obs_used) == ("unknown", "JPL", "", None, 406)
    assert [(r.element_name, r.element_value, r.sigma) for r in C.element_rows(c).collect()] == [("e", 0.333, 1e-9)]
    assert {r.param_name: (r.param_value_numeric, r.param_value_raw) for r in C.parameter_rows(c).collect()} == {"H": (19.6, "19.6"), "extent": (None, "1x2")}


def test_alternates_and_flags_keep_unknown_apart_from_none(spark):
    c = targets(spark, a=document(object__spkid="1", object__des_alt=GONE, object__neo=GONE, object__pha="true"), b=document(object__spkid="2", object__des_alt=[]))
    rows = by(C.object_rows(c), "spkid")
    assert rows["1"]["alternate_designations"] is None and rows["2"]["alternate_designations"] == []
    assert rows["1"]["is_neo"] is None and rows["1"]["is_pha"] is None


@pytest.mark.parametrize("change,defect", [
    (dict(object__spkid=GONE), "missing_spkid"), (dict(object__spkid=5), "missing_spkid"), (dict(object__des=" "), "missing_designation"),
    (dict(object__orbit_class={"code": "APO"}), "missing_orbit_class"), (dict(object__orbit_id=""), "missing_orbit_id"), (dict(orbit=GONE), "no_orbit_section"),
    (dict(object=[]), "no_object_section"), (dict(code=300), "several_matches"), (dict(list=[]), "several_matches"), (dict(orbit__epoch="0"), "invalid_epoch"),
    (dict(orbit__rms="-1"), "invalid_rms"), (dict(orbit__moid="-0.1"), "invalid_earth_moid"), (dict(orbit__n_obs_used="-3"), "invalid_n_obs_used"),
    (dict(orbit__elements=[]), "no_elements"), (dict(orbit__elements=[{"name": "e", "value": "-.1"}]), "negative_eccentricity"),
    (dict(orbit__elements=[{"name": "a", "value": "1"}]), None), (dict(phys_par={"x": 1}), "parameters_not_a_list"), (dict(phys_par=GONE), None),
    (dict(phys_par=[{"name": "H", "value": None}, {"name": " H "}]), "duplicate_parameter"),
])
def test_document_defects(spark, change, defect):
    assert targets(spark, a=document(**change)).first().defect == defect


def test_unreadable_document(spark):
    assert targets(spark, a="not json").first().defect == "not_an_object"


def test_targets_of_one_object(spark):
    broken = document(orbit__rms="bad")
    c = targets(spark, a=broken, b=document(), c=document(), d=broken, e=document(object__spkid=GONE))
    assert {r.target: r.status for r in c.collect()} == {"a": "failed", "b": "success", "c": "duplicate", "d": "duplicate", "e": "failed"}
    assert C.object_rows(c).count() == 1
    gate = catalog_gate(C.batch_tally(c, ["run_id"])).first()
    assert (gate.total_targets, gate.failure_rate_pct, gate.circuit_breaker_passed) == (5, 40.0, False)
    quarter = targets(spark, a=document(object__spkid="1"), b=document(object__spkid="2"), c=document(object__spkid="3"), d=broken)
    assert not catalog_gate(C.batch_tally(quarter, ["run_id"])).first().circuit_breaker_passed
    assert quarter.filter(F.col("status") == "failed").count() == 1


def parses(df) -> tuple[int, int]:
    """How often the plan parses JSON, and how often it reads its input."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return plan.toString().count("from_json("), plan.collectLeaves().size()


def test_records_are_read_and_parsed_once_for_their_verdicts(spark):
    rows = spark.createDataFrame([("f", "{}", 0)], "source_file string, record_json string, record_pos int").withColumn("entry_pos", F.lit(0))
    verdicts = A.classified_approaches(rows, ["source_file"]).groupBy("reject_reason").count()
    assert parses(verdicts) == (1, 1)
    # What no verdict needs isn't computed for them.
    assert "yyyy-MMM-d" not in verdicts._jdf.queryExecution().optimizedPlan().toString()
    assert parses(A.judge_approaches(rows, ["source_file"])) == (1, 1)
    assert parses(K.classified_risk(rows, ["source_file"]).groupBy("reject_reason").count())[1] == 1


def test_numbers_are_read_once(spark):
    from perigee.functions.numbers import to_double

    df = spark.createDataFrame([(t,) for t in ("1e999", "-1e999", "1e308", "-0.0", "NaN", " 5 ", None)], "t string").select(to_double(F.col("t")).alias("v"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    assert [str(r.v) for r in df.collect()] == ["None", "None", "1e+308", "-0.0", "None", "5.0", "None"]


def test_counts_written_in_any_way(spark):
    values = ['"5"', "5", "7.9", '"7.9"', "1e2", '"+5"', '" 6 "', "-3", "true", "9007199254740993", "123456789012345", "null"]
    doc = json.dumps({"data": []})[:-2] + ",".join('{"id":"%d","n_imp":%s}' % (i, v) for i, v in enumerate(values)) + "]}"
    records = risk_records(spark.createDataFrame([("f", doc)], "source_file string, payload string"))
    got = {int(r.sentry_id): r.potential_impacts_count for r in K.judge_risk(records, ["source_file"]).collect()}
    assert [got[i] for i in range(len(values))] == [5, 5, 7, None, 100, 5, 6, -3, None, 9007199254740992, 123456789012345, None]


def test_judging_a_replayed_record_is_compiled(spark):
    from perigee.plans.ingest import SOURCE
    from perigee.sources.raw import approach_entries

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.createDataFrame([("f", "d", "{}")], "source_file string, source_sha256 string, payload string")
        plan = A.settled_payloads(A.judge_approaches(approach_entries(docs), SOURCE), SOURCE)._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Above the limit the whole stage would be interpreted, field by field.
    assert 0 < max(sizes) <= int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))


def test_targets_are_judged_once(spark):
    docs = spark.createDataFrame([("r", "T1", "{}"), ("r", "T2", "[]")], "run_id string, target string, payload string")
    classified = C.classify_targets(docs, ["run_id"])
    assert parses(classified)[0] == 0 and {(r.target, r.status) for r in classified.collect()} == {("T1", "failed"), ("T2", "failed")}


def test_replayed_payloads_are_dealt_out_once(spark):
    from perigee.plans.ingest import replay_payloads

    near = lambda *records: json.dumps({"near_earth_objects": {"2026-09-29": list(records)}})
    docs = {"good": near(approach(), approach(id="2")), "copies": near(approach(name="first"), *[approach()] * 9), "late": near(*[approach(id=str(i)) for i in range(9)], approach(), approach(name="")),
            "cut": near(approach())[:-3], "none": near(), "bad": near(approach(id=""))}
    rows, gate = replay_payloads(spark.createDataFrame([(k, k, v) for k, v in docs.items()], "source_file string, source_sha256 string, payload string"))
    # Rows and gate are read from the written table as they are: no shuffle, no join.
    assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() for df in (rows, gate))
    assert {r.source_file: (r.records_received, r.valid_records, r.skipped_records, r.gate_passed, r.defect) for r in gate.collect()} == {
        "good": (2, 2, 0, True, None), "copies": (10, 1, 9, False, None), "late": (11, 9, 2, True, None),
        "cut": (0, 0, 0, False, "unreadable"), "none": (0, 0, 0, False, "empty"), "bad": (1, 0, 1, False, None)}
    assert sorted((r.source_raw_file, r.id, r.name) for r in rows.collect()) == [("good", "1", "(A)"), ("good", "2", "(A)"), *[("late", str(i), "(A)") for i in range(9)]]
