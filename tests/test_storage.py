import json

import pytest
from pyspark.sql import functions as F

from helpers import bridge_rows, by, make, risk_rows
from perigee import vocabulary as V
from perigee.operators.resolution import resolve
from perigee.plans import manifest, quality as Q
from perigee.plans.ingest import replay_approaches
from perigee.sources import sinks, tables
from perigee.sources.targets import resolve_targets
from perigee.streaming.landing import ingest_approaches, ingest_risk
from test_extraction import approach, risk


def rows_of(spark, n=3):
    return make(spark, "asteroids", *[dict(id=str(i), name="n", closest_approach_date=f"2026-10-0{i + 1}", miss_distance_km=float(i + 1), hazardous=False) for i in range(n)])


def test_missing_tables_are_typed_and_empty(spark, tmp_path):
    lake = tables.open_lakehouse(spark, str(tmp_path))
    assert lake.risk.count() == 0 and "sentry_id" in lake.risk.columns and lake.objects.schema["alternate_designations"].dataType.simpleString() == "array<string>"
    assert not tables.storage_ready(spark, str(tmp_path)).filter("present").count()
    tables.register_views(lake)
    assert spark.sql("select count(*) from fact_sbdb_orbit").first()[0] == 0


def test_contract(spark):
    with pytest.raises(ValueError):
        tables.check_contract(rows_of(spark).withColumn("extra", F.lit(1)), "asteroids")
    with pytest.raises(ValueError):
        tables.check_contract(rows_of(spark).withColumn("miss_distance_km", F.lit("x")), "asteroids")


def test_relational_load_is_idempotent(spark, tmp_path):
    rows = rows_of(spark).unionByName(rows_of(spark, 1).withColumn("closest_approach_date", F.lit("2027-01-01")))
    parents, children = sinks.load_relational(spark, rows, str(tmp_path))
    assert (parents.count(), children.count()) == (3, 4)
    parents, children = sinks.load_relational(spark, rows, str(tmp_path))
    assert (parents.count(), children.count()) == (0, 0)


def test_replay(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps({"near_earth_objects": {"d": [approach(id="7")]}}, indent=2))
    bad.write_text(json.dumps({"near_earth_objects": {"d": [approach(id="8"), approach(id="")]}}))
    rows, gate = replay_approaches(spark, str(tmp_path))
    got = rows.collect()
    import hashlib

    assert [(r.id, r.source_raw_file, r.source_raw_sha256) for r in got] == [("7", "good.json", hashlib.sha256(good.read_bytes()).hexdigest())]
    assert sorted(r.gate_passed for r in gate.collect()) == [False, True]


def test_packed_raw_documents_read_as_the_plain_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PACKED_DOCUMENTS", 10)
    docs = [json.dumps({"near_earth_objects": {"d": [approach(id=str(i))]}, "links": {"next": f"http://x?n={i}&api_key=s{i}"}}) for i in range(30)]
    payloads = spark.createDataFrame([*[(d,) for d in docs], ("",), (None,)], "payload string").coalesce(1)
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    sinks.write_raw(payloads, plain)
    sinks.write_raw(payloads, packed, packed=True)
    lines = lambda path: sorted(r.value for r in spark.read.text(path).collect())
    assert lines(packed) == lines(plain) and len(lines(packed)) == 32 and "api_key=s" not in "".join(lines(packed))
    # A packed file is read by one task: many documents are several files.
    assert len(list((tmp_path / "packed").glob("part-*.gz"))) == 4 and len(list((tmp_path / "plain").glob("part-*"))) == 1


def test_raw_replay_stores_its_documents_packed(spark):
    from pathlib import Path

    from perigee.bindings.registry import load
    from perigee.runtime import shared_folder

    stored = lambda: set(Path(shared_folder(spark)).glob("raw-*"))
    earlier = stored()
    load()["raw_replay"].run(spark, "/root/testdata/sf0.001").collect()
    (path,) = stored() - earlier
    text = spark.read.text(str(path)).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert 0 < 4 * sum(f.stat().st_size for f in path.glob("part-*")) < text


def test_streaming_ingest_adds_only_the_unseen(spark, tmp_path):
    land, table, check = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "check")
    land.mkdir()
    doc = lambda *r: json.dumps({"near_earth_objects": {"d": list(r)}})
    (land / "a.json").write_text(doc(approach(id="1"), approach(id="2")))
    ingest_approaches(spark, str(land), table, check).awaitTermination()
    (land / "b.json").write_text(doc(approach(id="2"), approach(id="3")))
    (land / "c.json").write_text(doc(approach(id="4"), approach(id="5"), approach(id="")))  # a third is refused: nothing of it loads
    (land / "d.json").write_text('{"near_earth_objects":{}}')
    (land / "e.json").write_text('{"near_earth_obj')
    ingest_approaches(spark, str(land), table, check).awaitTermination()
    assert sorted(r.id for r in tables.read_table(spark, table, "asteroids").collect()) == ["1", "2", "3"]
    refused = spark.read.parquet(f"{table}_quarantine").collect()
    assert sorted((r.source_file[-6:], r.records_received, r.defect) for r in refused) == [
        ("c.json", 3, None), ("d.json", 0, "empty"), ("e.json", 0, "unreadable")]

    risks, store = tmp_path / "risk", str(tmp_path / "risk_table")
    risks.mkdir()
    (risks / "2026-09-27_run7.json").write_text(json.dumps({"data": [risk(), risk(id="2", ip="0")]}))
    ingest_risk(spark, str(risks), store, str(tmp_path / "check2")).awaitTermination()
    row = tables.read_table(spark, store, "fact_sentry_risk_snapshot").first()
    assert (row.snapshot_key, row.run_id, row.sentry_id) == ("2026-09-27", "run7", "x31Q07T")


def test_targets(spark, tmp_path):
    f = tmp_path / "t.txt"
    f.write_text("# list\n (2010   TW54) \n\n2008 ST\n2010 TW54\n")
    assert [r.target for r in resolve_targets(spark, str(f), "x", "y").collect()] == ["2008 ST", "2010 TW54"]
    assert [r.target for r in resolve_targets(spark, targets=" b , a,,b").collect()] == ["a", "b"]
    assert [r.target for r in resolve_targets(spark, target=" (x) ").collect()] == ["x"]
    assert [r.target for r in resolve_targets(spark).collect()] == ["2025 HX"]


def output_folder(spark, folder, gate=True):
    head = dict(snapshot_key="2026-10-02", run_id="c", snapshot_time="2026-10-02T00:00:00Z", spkid="1")
    sinks.write_table_with_lineage(rows_of(spark), "asteroids", f"{folder}/asteroids.parquet", "r1", "t", "feed")
    for name in ("fact_sbdb_object_snapshot", "fact_sbdb_orbit", "fact_sbdb_orbit_element", "fact_sbdb_physical_parameter"):
        sinks.write_table(make(spark, name, head), name, f"{folder}/{name}.parquet")
    sinks.write_table(risk_rows(spark, dict(snapshot_key="2026-10-02")), "fact_sentry_risk_snapshot", f"{folder}/fact_sentry_risk_snapshot.parquet")
    crosswalk = resolve(rows_of(spark).select("id", "name"), make(spark, "fact_sbdb_object_snapshot", {**head, "designation": "n"}),
                        risk_rows(spark, dict(snapshot_key="2026-10-02")), "run", "2026-10-02")
    sinks.save_crosswalk(crosswalk, folder)
    summary = dict(run_id="r1", start_date="2026-10-01", end_date="2026-10-07", records_received=3, valid_records=3, skipped_records=0, rejection_pct=0.0, gate_passed=gate)
    batch = dict(run_id="c", snapshot_key="2026-10-02", total_targets=2, successful_targets_count=1, failed_targets_count=0, duplicate_targets_count=1,
                 failure_rate_pct=0.0, circuit_breaker_passed=True)
    for name, data in (("neows_summary.json", summary), ("sbdb_batch_summary.json", batch)):
        with open(f"{folder}/{name}", "w") as out:
            json.dump(data, out, indent=2)


def statuses(checks):
    return {r.check_name: r.status for r in checks.collect()}


def test_full_suite(spark, tmp_path):
    folder = str(tmp_path)
    missing = statuses(Q.full_suite(spark, folder))
    assert missing["neows_summary_presence"] == "FAILED" and missing["neows_gate_validation"] == "BLOCKED"
    assert missing["sbdb_structural_integrity"] == "BLOCKED" and missing["crosswalk_bridge_invariants"] == "NOT_APPLICABLE"
    output_folder(spark, folder)
    suite = Q.full_suite(spark, folder)
    got = statuses(suite)
    assert {k: v for k, v in got.items() if v != "PASSED"} == {"s3_publication_verification": "NOT_APPLICABLE"}
    total = Q.roll_up(suite).first()
    assert total.overall_status == "PASSED" and total.not_applicable == 1
    late = statuses(Q.full_suite(spark, folder, start_date="2026-10-02", verify=True, publish_keys=spark.createDataFrame([("asteroids.parquet",), ("nothing",)], "key string")))
    assert late["source_partition_dates"] == "FAILED" and late["s3_publication_verification"] == "FAILED"
    back = statuses(Q.full_suite(spark, folder, mode=V.BACKFILL))
    assert back["sentry_snapshot_validation"] == "NOT_APPLICABLE" and back["pre_resolution_output_accounting"] == "PASSED"


def test_lineage_checks(spark, tmp_path):
    base = dict(records_received=4, valid_records=3, skipped_records=1, rejection_pct=25.0, gate_passed=True, run_id="r1")
    frame = lambda **c: spark.createDataFrame([tuple({**base, **c}.values())], "records_received long, valid_records long, skipped_records long, rejection_pct double, gate_passed boolean, run_id string")
    assert Q.approach_summary_check(frame()).first().status == "FAILED"
    assert Q.approach_summary_check(frame(records_received=100, skipped_records=10, valid_records=90, rejection_pct=10.04)).first().status == "PASSED"
    assert Q.approach_summary_check(frame(records_received=100, skipped_records=10, valid_records=90, rejection_pct=10.2)).first().status == "FAILED"
    assert Q.approach_summary_check(frame(records_received=100, skipped_records=20, valid_records=80, rejection_pct=20.0)).first().status == "FAILED"
    runs = spark.createDataFrame([("r2",)], "run_id string")
    assert Q.approach_lineage_check(frame(), rows_of(spark)).first().status == "PASSED"
    assert Q.approach_lineage_check(frame(), rows_of(spark), runs).first().status == "FAILED"
    assert Q.approach_lineage_check(frame(gate_passed=False), rows_of(spark)).first().status == "FAILED"
    assert Q.approach_lineage_check(frame(gate_passed=False), None).first().status == "NOT_APPLICABLE"
    assert Q.approach_lineage_check(frame(), None).first().status == "FAILED"
    batch = spark.createDataFrame([(5, 3, 1, 1, 20.0, True)], "total_targets long, successful_targets_count long, failed_targets_count long, duplicate_targets_count long, failure_rate_pct double, circuit_breaker_passed boolean")
    assert Q.catalog_summary_check(batch).first().status == "PASSED"
    assert Q.catalog_summary_check(batch.withColumn("duplicate_targets_count", F.lit(0))).first().status == "FAILED"
    assert Q.catalog_lineage_check(batch, rows_of(spark), True).first().status == "PASSED"
    tripped = batch.withColumn("circuit_breaker_passed", F.lit(False))
    assert [Q.catalog_lineage_check(tripped, None, x).first().status for x in (True, False)] == ["FAILED", "NOT_APPLICABLE"]


def test_snapshot_and_crosswalk_checks(spark):
    ok = risk_rows(spark, dict(snapshot_key="2026-10-02"), dict(snapshot_key="2026-10-02", sentry_id="b"))
    assert Q.risk_snapshot_check(ok).first().status == "PASSED"
    assert Q.risk_snapshot_check(ok.limit(0)).first().status == "FAILED"
    assert Q.risk_snapshot_check(ok.unionByName(ok)).first().status == "FAILED"
    assert Q.risk_snapshot_check(ok.withColumn("impact_probability", F.lit(1.5))).first().status == "FAILED"
    good = bridge_rows(spark, ("k", "sbdb", "spkid", "1"), ("k", "neows", "id", "3"))
    assert Q.bridge_check(good).first().status == "PASSED"
    assert Q.bridge_check(good.limit(0)).first().status == "FAILED"
    assert Q.bridge_check(bridge_rows(spark, ("k", "neows", "id", "3"))).first().metrics["keys_with_invalid_pivots"] == "1"
    assert Q.bridge_check(good.unionByName(bridge_rows(spark, ("k", "neows", "id", "3")))).first().status == "FAILED"
    row = dict(resolution_run_id="r", resolved_at="t", source_system="neows", match_state="RESOLVED", assigned_asteroid_key="k")
    log = lambda *r: make(spark, "fact_entity_resolution", *[{**row, **x} for x in r])
    assert Q.audit_check(log({}), good).first().status == "PASSED"
    for bad in ([{}, {"resolution_run_id": "s"}], [{"match_state": "AMBIGUOUS"}], [{"assigned_asteroid_key": "zz"}]):
        assert Q.audit_check(log(*bad), good).first().status == "FAILED"


def test_partition_dates(spark):
    risks = risk_rows(spark, dict(snapshot_key="2026-10-02"), dict(snapshot_key="2026-10-02", sentry_id="b", snapshot_time="2026-10-03T00:00:00Z"))
    assert Q.partition_dates_check(spark, risk=risks, risk_date="2026-10-02").first().status == "FAILED"
    assert Q.partition_dates_check(spark, rows_of(spark), "2026-10-01", "2026-10-03").first().status == "PASSED"
    note = Q.partition_dates_check(spark, rows_of(spark), "2026-10-02", "2026-10-02").first()
    assert note.status == "FAILED" and "2026-10-01,2026-10-03" in note.diagnostic


def test_run_manifests(spark):
    runs = spark.createDataFrame([
        ("a", "current_production", "2026-10-01T00:00:00Z", "2026-10-01T00:01:30.5Z", None, None), ("b", "HISTORICAL_BACKFILL", "2026-10-01", None, -3.0, None),
        ("c", "CURRENT_PRODUCTION", "2026-10-01", None, None, "success"), ("d", "other", "2026-10-01", None, None, None)], manifest.RUN_DDL)
    none = (None,) * 4
    stages = spark.createDataFrame([
        ("a", "neows", "ok", False, None, None, None, ["k1", "k0?api_key=x"], {"token": "t"}), ("b", "sentry", "FAILED", *none, ["hidden"], {}),
        ("b", "sbdb", "ok", *none, [" k2 ", "k2", ""], {}), ("c", "x", "error", *none, None, {})], manifest.STAGE_DDL)
    got = by(manifest.run_manifests(runs, stages), "pipeline_run_id")
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["overall_status"] == "FAILED" and got["a"]["duration_seconds"] == 90.5 and got["a"]["published_key_count"] == 2
    assert got["b"]["overall_status"] == "SUCCESS" and got["b"]["duration_seconds"] == 0.0 and got["b"]["published_key_count"] == 1 and got["b"]["stage_count"] == 1
    assert {tuple(r) for r in manifest.manifest_keys(runs, stages).collect()} == {("a", "k0?api_key=REDACTED"), ("a", "k1"), ("b", "k2")}
    assert {(r.pipeline_run_id, r.stage, r.failed, len(r.details)) for r in manifest.manifest_stages(runs, stages).collect()} == {
        ("a", "neows", True, 0), ("b", "sbdb", False, 0), ("c", "x", True, 0)}
    assert got["c"]["overall_status"] == "SUCCESS" and got["a"]["manifest_path"].endswith("day=01/run_manifest_a.json")


def test_run_manifests_hold_their_keys(spark):
    runs = spark.createDataFrame([("a", "CURRENT_PRODUCTION", "2026-10-01", None, None, None), ("b", "CURRENT_PRODUCTION", "2026-10-01", None, None, None)], manifest.RUN_DDL)
    stages = spark.createDataFrame([("a", s, "ok", *(None,) * 4, keys, {}) for s, keys in (("x", ["k2", "k0?api_key=x"]), ("y", ["k1", " k2 "]))], manifest.STAGE_DDL)
    got = by(manifest.run_manifests(runs, stages), "pipeline_run_id")
    assert got["a"]["published_keys"] == ["k0?api_key=REDACTED", "k1", "k2"] and got["a"]["published_key_count"] == 3
    assert got["b"]["published_keys"] == [] and got["b"]["published_key_count"] == 0


def test_audit_log_of_several_runs(spark, tmp_path):
    from perigee.sources.runs import append_run, read_latest_run, read_runs, runs

    root = f"{tmp_path}/log"
    assert read_runs(spark, root).count() == 0 and read_latest_run(spark, root).count() == 0
    row = dict(source_system="neows", identifier_name="id", match_state="RESOLVED", assigned_asteroid_key="k")
    for run, at, values in (("b", "2026-01-02", ["1", "2"]), ("a", "2026-01-02", ["1"]), ("c", "2026-01-01", ["1", "2", "3"])):
        append_run(make(spark, "fact_entity_resolution", *[{**row, "resolution_run_id": run, "resolved_at": at, "source_identifier_value": v} for v in values]), root)
    assert read_runs(spark, root).count() == 6 and runs(spark, root).count() == 3
    newest = read_latest_run(spark, root)
    assert {(r.resolution_run_id, r.source_identifier_value) for r in newest.collect()} == {("b", "1"), ("b", "2")}
    assert "PartitionFilters: [isnotnull(resolution_run_id" in newest._jdf.queryExecution().executedPlan().toString()
    # A run whose rows are written but which isn't listed yet is not read.
    make(spark, "fact_entity_resolution", {**row, "resolution_run_id": "d", "resolved_at": "2026-09-09", "source_identifier_value": "1"}).write.mode("append").partitionBy("resolution_run_id").parquet(f"{root}/log")
    assert read_runs(spark, root).count() == 6 and {r.resolution_run_id for r in read_latest_run(spark, root).collect()} == {"b"}


def test_scratch_is_cleared(spark, monkeypatch):
    from perigee import runtime
    from perigee.sources.files import exists

    monkeypatch.setattr(runtime, "_WRITTEN", {})
    path = runtime.fresh_path(spark, "x")
    spark.range(3).write.parquet(path)
    runtime.materialize(spark.range(3), "y")
    assert exists(spark, path) and runtime.clear_scratch(spark) == 2 and not exists(spark, path)
    assert runtime.clear_scratch(spark) == 0
