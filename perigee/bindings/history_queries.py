"""Risk history, ad-hoc questions and distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.bindings import domain as D
from perigee.bindings.registry import query
from perigee.bindings.sql import with_tables
from perigee.functions import distance as S
from perigee.operators.picking import first_by, latest_by
from perigee.plans import adhoc, risk_history as H, sky

_METRICS = H.METRICS
_GAP = "(prev_key IS NOT NULL AND days > 1 AND steps < days)"


@query("snapshot_coverage", "C2 A4 W7", with_tables("SELECT * FROM cov", "cov"))
def _(spark, sf):
    return H.snapshot_coverage(D.risk_snapshots(spark, sf))


@query("risk_metric_history", "C3 J1 J2 W5 F12 F14 F15 F16", with_tables(f"""
SELECT snapshot_key, snapshot_time, sentry_id, designation, fullname, asteroid_key, {', '.join(_METRICS)},
  prev_key AS prev_snapshot_key, {', '.join(f'p.{m} AS prev_{m}' for m in _METRICS)},
  {', '.join(f'x.{m} - p.{m} AS delta_{m}' for m in H.DELTAS)}, date_diff('day', p.last_obs_date::DATE, x.last_obs_date::DATE) AS delta_last_obs_days,
  prev_key IS NULL AS is_first_snapshot, coalesce(x.last_obs_date > p.last_obs_date, false) AS has_new_observations,
  prev_key IS NOT NULL AND (x.impact_probability <> p.impact_probability OR x.palermo_scale_max <> p.palermo_scale_max
    OR x.torino_scale_max <> p.torino_scale_max OR x.potential_impacts_count <> p.potential_impacts_count) AS is_metric_changed,
  {_GAP} AS coverage_gap_flag
FROM (SELECT r.*, x, p, p.snapshot_key AS prev_key, seq - p.seq AS steps, date_diff('day', p.snapshot_key::DATE, r.snapshot_key::DATE) AS days
  FROM (SELECT *, lag(x) OVER (PARTITION BY sentry_id ORDER BY snapshot_key) AS p FROM (
    SELECT r.*, cov.snapshot_seq AS seq, b.asteroid_key, {{'snapshot_key': r.snapshot_key, 'seq': cov.snapshot_seq, {', '.join(f"'{m}': r.{m}" for m in _METRICS)}}} AS x
    FROM rsk r JOIN cov USING (snapshot_key) LEFT JOIN (SELECT identifier_value, asteroid_key FROM brg
      WHERE source_system = 'sentry' AND identifier_name = 'sentry_id') b ON b.identifier_value = r.sentry_id)) r)""", "rsk", "cov", "brg"))
def _(spark, sf):
    bridge, _audit = D.published_crosswalk(spark, sf)
    return H.risk_metric_history(D.risk_snapshots(spark, sf), bridge)


@query("presence_history", "C4 J3 W6 F16 F17", with_tables(f"""
SELECT * EXCLUDE (steps, days, prev_key), days AS days_since_prev, {_GAP} AS coverage_gap_flag, st AS presence_state,
  coalesce(st = 'EXIT_AFTER_THIS_SNAPSHOT', false) AS is_exit_after_this_snapshot FROM (
SELECT *, CASE WHEN steps < days THEN NULL
    WHEN global_next_days_diff = 1 AND (seq_next IS NULL OR seq_next - seq_curr > 1) THEN 'EXIT_AFTER_THIS_SNAPSHOT'
    WHEN prev_key IS NULL THEN 'NEW_ENTRY' WHEN days = 1 THEN 'PERSISTENT' WHEN steps = days THEN 'RE_ENTRY' END AS st FROM (
SELECT *, prev_snapshot_key AS prev_key, seq_curr - seq_prev AS steps, date_diff('day', prev_snapshot_key::DATE, snapshot_key::DATE) AS days FROM (
SELECT r.snapshot_key, snapshot_time, sentry_id, designation, fullname, c.snapshot_seq AS seq_curr,
  lag(c.snapshot_seq) OVER w AS seq_prev, lag(r.snapshot_key) OVER w AS prev_snapshot_key,
  lead(c.snapshot_seq) OVER w AS seq_next, lead(r.snapshot_key) OVER w AS next_snapshot_key, nk AS global_next_snapshot_key,
  date_diff('day', r.snapshot_key::DATE, nk::DATE) AS global_next_days_diff
FROM rsk r JOIN (SELECT *, lead(snapshot_key) OVER (ORDER BY snapshot_key) AS nk FROM cov) c USING (snapshot_key)
WINDOW w AS (PARTITION BY sentry_id ORDER BY r.snapshot_key))))""".replace("EXCLUDE (steps, days, prev_key)", "EXCLUDE (steps, days, prev_key, st)"), "rsk", "cov"))
def _(spark, sf):
    return H.presence_history(D.risk_snapshots(spark, sf))


@query("object_lifecycle", "C5 A7 A8 A9 F13 W8", with_tables("""
SELECT lif.* EXCLUDE (nk, yrange), coalesce(nk, 0) > 1 AS is_crosswalk_ambiguous,
  date_diff('day', first_snapshot_key::DATE, last_snapshot_key::DATE) + 1 AS archive_observation_span_days,
  CASE WHEN NOT stale THEN last_snapshot_key = gk END AS is_currently_active FROM lif, now""", "lif", "now"))
def _(spark, sf):
    bridge, _audit = D.published_crosswalk(spark, sf)
    return H.object_lifecycle(D.risk_snapshots(spark, sf), bridge, D.AS_OF)


@query("risk_history_by_run", "C16 W9", with_tables(f"""
SELECT {', '.join(H.HISTORY_COLUMNS)}, coalesce(impact_probability <> lag(impact_probability) OVER w, false) AS is_impact_probability_changed,
  coalesce(palermo_scale_max <> lag(palermo_scale_max) OVER w, false) AS is_palermo_scale_max_changed
FROM (SELECT * FROM run2 QUALIFY row_number() OVER (PARTITION BY snapshot_key, sentry_id ORDER BY snapshot_time DESC, run_id DESC) = 1)
WINDOW w AS (PARTITION BY sentry_id ORDER BY snapshot_key)""", "run2"))
def _(spark, sf):
    return H.risk_history(D.risk_runs(spark, sf))


@query("latest_event_per_user", "W1", """
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    events = D.table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return latest_by(events, ["user_id"], ["ts", "event_id"])


@query("first_line_per_order", "W3 T1", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_extendedprice, l_partkey, l_linenumber) = 1""")
def _(spark, sf):
    lines = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    return first_by(lines, ["l_orderkey"], ["l_shipdate", "l_extendedprice", "l_partkey", "l_linenumber"])


# --- ad-hoc questions --------------------------------------------------------------------------

@query("day_partition_listing", "P10 S3", with_tables("""
SELECT id, name, closest_approach_date, miss_distance_km, hazardous FROM apr WHERE year = '1998' AND month = '10' AND day = '03'""", "apr"))
def _(spark, sf):
    return adhoc.daily_listing(D.approaches(spark, sf), "1998", "10", "03")


@query("month_hazard_summary", "A3", with_tables("""
SELECT hazardous, count(*) AS asteroid_count, round(min(miss_distance_km), 2) AS min_miss_distance_km,
  round(avg(miss_distance_km), 2) AS avg_miss_distance_km, round(max(miss_distance_km), 2) AS max_miss_distance_km
FROM apr WHERE year = '1997' AND month = '05' GROUP BY hazardous""", "apr"))
def _(spark, sf):
    return adhoc.monthly_summary(D.approaches(spark, sf), "1997", "05")


@query("hazardous_week_top10", "P10 T1", with_tables("""
SELECT id, name, closest_approach_date, miss_distance_km FROM apr
WHERE hazardous AND closest_approach_date BETWEEN '1997-05-17' AND '1997-05-24'
ORDER BY miss_distance_km, id, closest_approach_date LIMIT 10""", "apr"))
def _(spark, sf):
    return adhoc.hazardous_in_range(D.approaches(spark, sf), "1997", "05", "17", "24")


@query("approach_totals", "A1", """
SELECT count(*) AS total_asteroids, count(*) FILTER (o_orderstatus = 'F') AS hazardous_asteroids,
  round(avg(o_totalprice * 100), 4) AS average_miss_distance_km FROM orders""")
def _(spark, sf):
    return adhoc.totals(D.approaches(spark, sf)).withColumn("average_miss_distance_km", F.round("average_miss_distance_km", 4))


@query("approaches_by_hazard", "A2", with_tables("SELECT hazardous, count(*) AS asteroid_count FROM apr GROUP BY 1", "apr"))
def _(spark, sf):
    return adhoc.by_hazard(D.approaches(spark, sf))


@query("approaches_by_date", "A2", with_tables(
    "SELECT closest_approach_date, count(*) AS asteroid_count FROM apr GROUP BY 1 ORDER BY 1", "apr"))
def _(spark, sf):
    return adhoc.by_date(D.approaches(spark, sf))


_TOP = "SELECT id, name, closest_approach_date, miss_distance_km, hazardous FROM apr {} ORDER BY miss_distance_km {}, id, closest_approach_date LIMIT {}"


@query("closest_ten", "T1", with_tables(_TOP.format("", "", 10), "apr"))
def _(spark, sf):
    return adhoc.closest(D.approaches(spark, sf))


@query("closest_hazardous_ten", "T1", with_tables(_TOP.format("WHERE hazardous", "", 10), "apr"))
def _(spark, sf):
    return adhoc.closest(D.approaches(spark, sf), hazardous_only=True)


@query("farthest_ten", "T1", with_tables(_TOP.format("", "DESC", 10), "apr"))
def _(spark, sf):
    return adhoc.farthest(D.approaches(spark, sf))


@query("closest_one", "T1", with_tables(_TOP.format("", "", 1), "apr"))
def _(spark, sf):
    return adhoc.closest(D.approaches(spark, sf), 1)


@query("hazardous_beyond_10m_km", "P12", with_tables(
    "SELECT id, name, miss_distance_km FROM apr WHERE hazardous AND miss_distance_km > 10000000", "apr"))
def _(spark, sf):
    return adhoc.hazardous_beyond(D.approaches(spark, sf))


# --- distances ---------------------------------------------------------------------------------

def _events_km(spark, sf):
    """Event values spread over the whole scale, from near the surface to tens of millions of km."""
    return D.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("neows_id"), (F.col("value") * F.col("value") * F.col("value")).alias("miss_distance_km"))


_KM = "SELECT event_id::VARCHAR AS neows_id, value * value * value AS km FROM events"
_H = "CASE WHEN km <= 384400 THEN 160 * ln(1 + km / 6371) / ln(1 + 384400 / 6371.0::DOUBLE) WHEN km <= 1e6 THEN 160 + 60 * (km - 384400) / (1e6 - 384400) ELSE 220 + 120 * (km - 1e6) / 1e6 END"
_P = ("CASE WHEN km <= 6371 THEN 0 WHEN km <= 384400 THEN 0.16::DOUBLE * ln(km / 6371) / ln(384400 / 6371.0::DOUBLE) "
      "WHEN km <= 1e6 THEN 0.16::DOUBLE + 0.06::DOUBLE * ln(km / 384400) / ln(1e6 / 384400) "
      "ELSE 0.22::DOUBLE + (least(km, mx) - 1e6) / (mx - 1e6) * 0.78::DOUBLE END")
_MX = "greatest(1e8, ceil(max(km) * 1.05::DOUBLE / 1e7) * 1e7)"


@query("distance_domain", "A18", f"SELECT 6371.0::DOUBLE AS min_km, {_MX} AS max_km FROM ({_KM})")
def _(spark, sf):
    return sky.distance_domain(_events_km(spark, sf))


@query("distance_heights", "F25", f"SELECT neows_id, round({_H}, 6) AS height FROM ({_KM})")
def _(spark, sf):
    rows = _events_km(spark, sf)
    return rows.select("neows_id", F.round(S.height(F.col("miss_distance_km"), 160.0, 220.0, 120.0), 6).alias("height"))


@query("distance_progress", "F26", f"""
SELECT neows_id, round({_P}, 9) AS progress, abs({_P} - {_P}) < 1e-9 AS round_trip FROM ({_KM}), (SELECT {_MX} AS mx FROM ({_KM}))""")
def _(spark, sf):
    from perigee.runtime import one_row

    rows = _events_km(spark, sf)
    rows = rows.crossJoin(one_row(sky.distance_domain(rows)))
    p = S.progress_at(F.col("miss_distance_km"), F.col("max_km"))
    back = S.progress_at(S.revealed_km(p, F.col("max_km")), F.col("max_km"))
    return rows.select("neows_id", F.round(p, 9).alias("progress"), (F.abs(back - p) < 1e-9).alias("round_trip"))


@query("reveal_order", "T6", f"SELECT neows_id, km AS miss_distance_km FROM ({_KM}) ORDER BY km, neows_id")
def _(spark, sf):
    return sky.reveal_order(_events_km(spark, sf))


_STEPS = [0.0, 0.05, 0.1, 0.16, 0.19, 0.22, 0.4, 0.7, 1.0]


@query("reveal_counts", "F27 F26", f"""
SELECT p AS progress, round(f, 6) AS frontier_km, (SELECT count(*) FROM ({_KM}) WHERE km <= f) AS revealed FROM (
SELECT p, CASE WHEN p = 0 THEN 0 WHEN p <= 0.16 THEN 6371 * pow(384400 / 6371.0::DOUBLE, p / 0.16::DOUBLE)
  WHEN p <= 0.22 THEN 384400 * pow(1e6 / 384400, (p - 0.16::DOUBLE) / (0.22::DOUBLE - 0.16::DOUBLE))
  ELSE least(mx, 1e6 + (mx - 1e6) * ((p - 0.22::DOUBLE) / (1 - 0.22::DOUBLE))) END AS f
FROM (SELECT unnest({_STEPS}::DOUBLE[]) AS p), (SELECT {_MX} AS mx FROM ({_KM})))""")
def _(spark, sf):
    return sky.reveal_counts(_events_km(spark, sf), _STEPS).withColumn("frontier_km", F.round("frontier_km", 6))


@query("distance_bands", "F28", f"""
SELECT band, CASE WHEN band % 10 = 0 THEN 'major' WHEN band % 5 = 0 THEN 'mid' ELSE 'minor' END AS tier, count(km) AS objects
FROM (SELECT unnest(range(1, (SELECT {_MX} FROM ({_KM}))::BIGINT // 1000000 + 1)) AS band) LEFT JOIN ({_KM}) ON floor(km / 1e6) = band GROUP BY band""")
def _(spark, sf):
    return sky.band_counts(_events_km(spark, sf))
