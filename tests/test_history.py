from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bridge_rows, by, risk_rows
from perigee.operators.picking import first_by, insert_if_absent, latest_by, most_severe, preferred_pivot
from perigee.operators.sequencing import in_sequence, not_dates, with_neighbours
from perigee.plans import risk_history as H

AS_OF = "2026-09-27T00:00:00Z"
D = ["2026-09-0" + str(i) for i in range(10)]


def test_coverage(spark):
    risk = risk_rows(spark, dict(snapshot_key=D[1]), dict(snapshot_key=D[1], sentry_id="id_2", snapshot_time=f"{D[1]}T00:00:10Z"), dict(snapshot_key=D[3]))
    got = by(H.snapshot_coverage(risk), "snapshot_key")
    assert got[D[1]] == dict(snapshot_key=D[1], is_captured=True, row_count=2, first_snapshot_time=f"{D[1]}T00:00:00Z",
                             last_snapshot_time=f"{D[1]}T00:00:10Z", snapshot_seq=1)
    assert got[D[3]]["snapshot_seq"] == 2


def test_sequence_over_months_and_years(spark):
    days = [date(2023, 11, 28) + timedelta(days=i * i % 900) for i in range(300)]
    keys = sorted({str(d) for d in days})
    got = by(in_sequence(spark.createDataFrame([(k,) for k in keys], "k string").repartition(5), "k"), "k")
    assert [got[k]["seq"] for k in keys] == list(range(1, len(keys) + 1))
    assert [got[k]["next_key"] for k in keys] == [*keys[1:], None]
    # Keys that aren't dates keep their place in the order of texts, and are named.
    odd = sorted([*keys[:40], "2023", "2024-01-03#2", "x", "", "2024-13-01", "2024-1-1"])
    frame = spark.createDataFrame([(k,) for k in odd], "k string")
    got = by(in_sequence(frame, "k"), "k")
    assert [(got[k]["seq"], got[k]["next_key"]) for k in odd] == list(zip(range(1, len(odd) + 1), [*odd[1:], None]))
    assert {r.k for r in not_dates(frame, "k").collect()} == {"2023", "2024-01-03#2", "x", "", "2024-13-01", "2024-1-1"}
    assert in_sequence(frame.limit(0), "k").count() == 0


def test_no_window_holds_all_keys(spark):
    plan = H.snapshot_coverage(risk_rows(spark, dict(snapshot_key=D[1])))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    alone = [line for line in windows if "], [part#" in line and "outer#" not in line]
    assert len(windows) >= 3 and len(alone) == 1 and "snapshot_key" not in alone[0].split("], [")[1]


def test_metric_history(spark):
    risk = risk_rows(
        spark, dict(snapshot_key=D[1]), dict(snapshot_key=D[2]),
        dict(snapshot_key=D[4], impact_probability=3e-6, torino_scale_max=1, last_obs_date="2020-01-04", palermo_scale_max=None),
        dict(snapshot_key=D[1], sentry_id="other"))
    got = by(H.risk_metric_history(risk, bridge_rows(spark, ("k1", "sentry", "sentry_id", "id_1"))), "sentry_id", "snapshot_key")
    first, second, third = (got["id_1", D[i]] for i in (1, 2, 4))
    assert first["is_first_snapshot"] and first["prev_snapshot_key"] is None and not first["coverage_gap_flag"]
    assert not first["is_metric_changed"] and not first["has_new_observations"] and first["delta_impact_probability"] is None
    assert not second["is_metric_changed"] and second["delta_last_obs_days"] == 0 and second["asteroid_key"] == "k1"
    assert third["is_metric_changed"] and third["has_new_observations"] and third["coverage_gap_flag"]
    assert third["delta_impact_probability"] == pytest.approx(2e-6) and third["delta_torino_scale_max"] == 1
    assert third["delta_palermo_scale_max"] is None and third["delta_last_obs_days"] == 20
    assert got["other", D[1]]["asteroid_key"] is None  # unresolved objects stay


def test_history_fans_out_over_several_entities(spark):
    bridge = bridge_rows(spark, ("k1", "sentry", "sentry_id", "id_1"), ("k2", "sentry", "sentry_id", "id_1"))
    risk = risk_rows(spark, dict(snapshot_key=D[1]))
    assert {r.asteroid_key for r in H.risk_metric_history(risk, bridge).collect()} == {"k1", "k2"}
    life = H.object_lifecycle(risk, bridge, AS_OF).first()
    assert life.asteroid_key is None and life.is_crosswalk_ambiguous


@pytest.mark.parametrize("present,captured,expected", [
    ([1], [1], {1: "NEW_ENTRY"}),
    ([1, 2], [1, 2], {1: "NEW_ENTRY", 2: "PERSISTENT"}),
    ([1, 3], [1, 2, 3], {1: "EXIT_AFTER_THIS_SNAPSHOT", 3: "RE_ENTRY"}),
    ([1], [1, 2], {1: "EXIT_AFTER_THIS_SNAPSHOT"}),
    ([1], [1, 3], {1: "NEW_ENTRY"}),
    ([1, 3], [1, 3], {1: "NEW_ENTRY", 3: None}),
])
def test_presence(spark, present, captured, expected):
    rows = [dict(snapshot_key=D[d]) for d in present] + [dict(snapshot_key=D[d], sentry_id="filler") for d in captured]
    got = {k: v for k, v in by(H.presence_history(risk_rows(spark, *rows)), "sentry_id", "snapshot_key").items() if k[0] == "id_1"}
    assert {d: got["id_1", D[d]]["presence_state"] for d in present} == expected
    for row in got.values():
        assert row["is_exit_after_this_snapshot"] == (row["presence_state"] == "EXIT_AFTER_THIS_SNAPSHOT")
    assert got["id_1", D[present[-1]]]["coverage_gap_flag"] == (expected[present[-1]] is None)


def test_lifecycle(spark):
    risk = risk_rows(
        spark, dict(snapshot_key="2026-09-24", estimated_diameter_km=None, absolute_magnitude=18.0, impact_probability=9e-6),
        dict(snapshot_key="2026-09-25", estimated_diameter_km=0.5), dict(snapshot_key="2026-09-26", estimated_diameter_km=None, fullname="new"),
        dict(snapshot_key="2026-09-25", sentry_id="gone"))
    got = by(H.object_lifecycle(risk, bridge_rows(spark, ("k1", "sentry", "sentry_id", "id_1")), AS_OF), "sentry_id")
    row = got["id_1"]
    assert (row["asteroid_key"], row["fullname"], row["total_snapshots_observed"], row["archive_observation_span_days"]) == ("k1", "new", 3, 3)
    assert (row["initial_estimated_diameter_km"], row["latest_estimated_diameter_km"], row["latest_absolute_magnitude"]) == (0.5, 0.5, 18.0)
    assert row["initial_impact_probability"] == row["all_time_max_impact_probability"] == 9e-6 and row["latest_impact_probability"] == 1e-6
    assert row["is_currently_active"] is True and got["gone"]["is_currently_active"] is False
    late = by(H.object_lifecycle(risk, bridge_rows(spark), "2026-09-28T01:00:00Z"), "sentry_id")
    assert late["id_1"]["is_currently_active"] is None


def test_runs_of_one_day_are_deduplicated(spark):
    risk = risk_rows(
        spark, dict(snapshot_key=D[1], run_id="a", impact_probability=1e-6), dict(snapshot_key=D[1], run_id="b", impact_probability=2e-6),
        dict(snapshot_key=D[2], impact_probability=2e-6), dict(snapshot_key=D[3], impact_probability=None), dict(snapshot_key=D[4], impact_probability=5e-6))
    rows = H.risk_history(risk, " id_1 ").orderBy("snapshot_key").collect()
    assert [r.impact_probability for r in rows] == [2e-6, 2e-6, None, 5e-6]
    assert [r.is_impact_probability_changed for r in rows] == [False, False, False, False]
    assert H.risk_history(risk, "nobody").count() == 0


def test_neighbours_of_a_hot_key_match_a_plain_window(spark):
    """A third of all rows on one key, several per day: the bucketed form must give what one window gives."""
    start = date(2026, 1, 1)
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        F.date_format(F.date_add(F.lit(start), (F.col("id") * 7 % 200).cast("int")), "yyyy-MM-dd").alias("d"),
        F.col("id").alias("n"))
    plain = with_neighbours(df, ["k"], ["d", "n"], ["d", "n"], want_next=True)
    cut = with_neighbours(df, ["k"], ["d", "n"], ["d", "n"], bucket=F.substring("d", 1, 7), want_next=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))
    assert start + timedelta(days=199) > start


def test_picks(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 1, 5, "y"), ("a", 0, 9, "z"), ("b", None, 1, "w")], "k string, o int, p int, v string")
    assert by(latest_by(df, ["k"], ["o", "p"]), "k")["a"]["v"] == "y"
    assert by(first_by(df, ["k"], ["p"]), "k")["a"]["v"] == "y"  # NULL sorts last
    states = spark.createDataFrame([("i", "RESOLVED"), ("i", "INVALID"), ("j", "UNRESOLVED")], "k string, s string")
    from perigee.vocabulary import STATE_SEVERITY

    assert by(most_severe(states, ["k"], "s", STATE_SEVERITY), "k")["i"]["s"] == "INVALID"
    bridge = bridge_rows(spark, ("k", "sbdb", "spkid", "9", True), ("k", "sbdb", "spkid", "1", False), ("m", "sbdb", "spkid", "5", False))
    assert {r.asteroid_key: r.spkid for r in preferred_pivot(bridge, "sbdb", "spkid").collect()} == {"k": "9", "m": "5"}
    new = insert_if_absent(df.filter("k = 'b'"), df, ["k"])
    assert [r.k for r in new.collect()] == ["a"]
