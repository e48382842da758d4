"""The derived tables and the crosswalk as SQL, for the independent checks.

`with_tables(body, "apr", ...)` prefixes a query with the named tables and whatever they need.
"""

from __future__ import annotations

from perigee.bindings.domain import AS_OF, ELEMENT_BY_LINE, PARAMETER_BY_FLAGS, RESOLVED_AT, RUN_ID
from perigee.operators import resolution as R
from perigee.vocabulary import KEY_NAMESPACE


def strip(x: str) -> str:
    return f"trim({x})"


def squeeze(x: str) -> str:
    return f"regexp_replace(trim({x}), '\\s+', ' ', 'g')"


def norm(x: str) -> str:
    """Designation normal form; the projections hold only plain spaces."""
    once = squeeze(x)
    inner = f"CASE WHEN {once} LIKE '(%)' THEN substr({once}, 2, length({once}) - 2) ELSE {once} END"
    return f"upper({squeeze(inner)})"


def key_of(x: str) -> str:
    """Name-based UUID (version 5) of spk:<id> from the SHA-1 hex digest."""
    h = f"sha1(unhex('{KEY_NAMESPACE.replace('-', '')}') || encode('spk:' || {x}))"
    variant = f"substr('89ab89ab89ab89ab', ('0x' || substr({h}, 17, 1))::INT + 1, 1)"
    return (f"'ast_' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant}"
            f" || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)")


def jtext(x: str) -> str:
    """A JSON string, NULL for NULL. The texts here need no escapes."""
    return f"'\"' || {x} || '\"'"


def jlist(x: str) -> str:
    return f"'[' || array_to_string(list_transform({x}, lambda e: '\"' || e || '\"'), ',') || ']'"


def proof(**entries: str) -> str:
    """A JSON object of already encoded values, sorted by key, without the NULL ones."""
    parts = ", ".join(f"'\"{k}\":' || {entries[k]}" for k in sorted(entries))
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def _case(mapping: dict, key: str) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {key} {whens} END"


def _risk(half: str) -> str:
    des = "CASE WHEN user_id % 50 = 49 THEN ' ' WHEN user_id % 50 = 48 THEN 'M 3' ELSE '2024 C' || (CASE WHEN user_id % 4 = 3 THEN user_id - 1 ELSE user_id END) END"
    return f"""
SELECT strftime(snap, '%Y-%m-%d') AS snapshot_key, 'risk-' || strftime(snap, '%Y-%m-%d') || half AS run_id,
  strftime(snap, '%Y-%m-%d') || 'T' || strftime(min(ts), '%H:%M:%S') || 'Z' AS snapshot_time,
  'u' || user_id AS sentry_id, {des} AS designation, '(' || {des} || ')' AS fullname,
  floor(min(value) FILTER (event_type = 'purchase'))::DOUBLE AS absolute_magnitude,
  floor(max(value) FILTER (event_type = 'view') / 10) / 100 AS estimated_diameter_km,
  floor(max(value) / 100) / 1000 AS impact_probability, count(*) AS potential_impacts_count,
  floor(min(value)) / 4 - 6 AS palermo_scale_cum, floor(max(value) / 50) / 2 - 5 AS palermo_scale_max,
  count(*) FILTER (event_type = 'error') AS torino_scale_max, floor(max(value))::DOUBLE AS v_infinity_km_s,
  CASE WHEN count(*) = 1 THEN '' ELSE '2030-' || (2030 + count(*)) END AS impact_year_range,
  strftime(snap - CAST(count(*) % 4 AS INTEGER), '%Y-%m-%d') AS last_obs_date, 2460000.5::DOUBLE + max(event_id) AS last_obs_jd
FROM (SELECT *, {half} AS half, DATE '2024-01-01' + CAST(o + o // 10 AS INTEGER) AS snap
      FROM (SELECT *, date_diff('day', DATE '2024-01-01', ts::DATE) AS o FROM events))
GROUP BY snap, half, user_id"""


_DES = ("CASE WHEN seg = 'MACHINERY' AND nat < 5 THEN 'M ' || nat WHEN seg = 'AUTOMOBILE' AND nat = 24 AND yr % 2 = 0 "
        "THEN '2024 X' || k ELSE '2024 C' || k END")
_SNAP = "yr || '-12-31' AS snapshot_key, 'cat-' || yr AS run_id, yr || '-12-31T06:00:00Z' AS snapshot_time, '20' || k AS spkid"


def _audit(system, name, value, target, target_name, spkid, state, rule, ev) -> str:
    feed = "NULL" if target == "NULL" else "'sbdb'"
    tname = "NULL" if target == "NULL" else f"'{target_name}'"
    return (f"SELECT '{system}' AS sys, '{name}' AS nm, {value} AS val, {feed} AS tsys, {tname} AS tnm, {target} AS tval, "
            f"{spkid} AS spk, '{state}' AS st, {rule} AS rl, {ev} AS ev")


def _lit(text: str) -> str:
    return f"'\"{text}\"'"


TABLES: dict[str, tuple[list[str], str]] = {
    "idn": ([], "SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS nat, c_name AS cname, c_acctbal AS bal FROM customer"),
    "ord": ([], "SELECT *, o_orderdate::DATE AS dt, year(o_orderdate) AS yr, o_custkey AS k FROM orders"),
    "cat": (["idn", "ord"], f"""
SELECT yr || '-12-31' AS snapshot_key, 'cat-' || yr AS run_id, yr || '-12-31T06:00:00Z' AS snapshot_time,
  CASE WHEN seg = 'FURNITURE' AND nat = 20 THEN '  ' ELSE '20' || k END AS spkid, {_DES} AS designation,
  '(' || cname || CASE WHEN seg = 'BUILDING' AND nat = 24 AND yr % 2 = 0 THEN ' bis' ELSE '' END || ')' AS fullname,
  CASE WHEN bal >= 0 THEN cname END AS shortname, 'an' AS object_kind,
  CASE nat % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_neo,
  CASE WHEN bal > 5000 THEN true WHEN bal >= 0 THEN false END AS is_pha,
  substr(seg, 1, 3) AS orbit_class_code, seg AS orbit_class_name, last_order::VARCHAR AS orbit_id, NULL::VARCHAR AS prefix,
  CASE WHEN nat = 23 THEN NULL WHEN nat = 22 THEN []::VARCHAR[] WHEN nat = 21 THEN ['A-21'] ELSE [' A-' || k || ' ', {_DES}] END
    AS alternate_designations
FROM (SELECT k, yr, max(o_orderkey) AS last_order FROM ord GROUP BY ALL) JOIN idn USING (k)"""),
    "apr": (["idn", "ord"], """
SELECT CASE WHEN seg = 'AUTOMOBILE' THEN '20' || k WHEN seg = 'BUILDING' THEN '30' || k WHEN seg = 'FURNITURE' THEN '40' || k
    WHEN seg = 'HOUSEHOLD' THEN '50' || k WHEN nat = 10 THEN ' ' WHEN nat = 9 THEN 'N' || k ELSE '60' || k END AS id,
  CASE WHEN seg = 'AUTOMOBILE' AND nat < 5 THEN '2024 C' || (k + 1) WHEN seg = 'AUTOMOBILE' THEN '(2024 C' || k || ')'
    WHEN seg = 'BUILDING' AND nat = 6 AND yr % 2 = 0 THEN '2024 C' || (k + 1) WHEN seg = 'BUILDING' THEN '(  2024   c' || k || ' )'
    WHEN seg = 'FURNITURE' THEN cname WHEN seg = 'HOUSEHOLD' AND nat = 21 THEN 'A-21' WHEN seg = 'HOUSEHOLD' THEN 'a-' || k
    WHEN nat < 5 THEN 'M ' || nat WHEN nat = 11 THEN NULL ELSE '2024 C' || k END AS name,
  strftime(dt, '%Y-%m-%d') AS closest_approach_date, o_totalprice * 100 AS miss_distance_km,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS hazardous,
  CASE WHEN p <> '4' THEN strftime(dt, '%Y-%m-%d') || 'T07:18' END AS close_approach_datetime,
  o_orderkey * 1000 AS close_approach_epoch_ms, CASE WHEN p <> '3' THEN o_totalprice / 10000 END AS relative_velocity_km_s,
  10 + nat / 2.0::DOUBLE AS absolute_magnitude_h, CASE WHEN p <> '2' THEN o_totalprice / 1e6 END AS estimated_diameter_min_km,
  CASE WHEN p <> '2' THEN o_totalprice / 4e5 END AS estimated_diameter_max_km,
  CASE p WHEN '1' THEN true WHEN '5' THEN false END AS is_sentry_object,
  strftime(dt, '%Y') AS year, strftime(dt, '%m') AS month, strftime(dt, '%d') AS day
FROM (SELECT *, substr(o_orderpriority, 1, 1) AS p FROM ord) JOIN idn USING (k)"""),
    "rsk": ([], _risk("'a'")),
    "run2": ([], _risk("CASE WHEN hour(ts) < 12 THEN 'a' ELSE 'b' END")),
    "orb": (["ord"], f"""
SELECT {_SNAP}, o_orderstatus AS orbit_id, 2450000.5::DOUBLE + max(o_orderkey) AS epoch_jd,
  CASE WHEN p = '2' THEN '' ELSE 'J2000' END AS equinox, strftime(max(dt), '%Y-%m-%d') AS soln_date, 'JPL' AS orbit_source,
  NULL::VARCHAR AS producer, strftime(min(dt), '%Y-%m-%d') AS first_obs, strftime(max(dt), '%Y-%m-%d') AS last_obs,
  CASE WHEN p <> '4' THEN date_diff('day', min(dt), max(dt)) END AS data_arc_days, CASE WHEN p <> '4' THEN count(*) * 15 END AS n_obs_used,
  CASE WHEN p = '4' THEN NULL WHEN p = '5' THEN 'unknown' ELSE p END AS condition_code, min(o_totalprice) / 1e6 AS rms,
  min(o_totalprice) / 1e7 AS earth_moid_au, max(o_totalprice) / 1e5 AS jupiter_moid_au, count(*) / 2.0::DOUBLE AS t_jup
FROM (SELECT *, max(substr(o_orderpriority, 1, 1)) OVER (PARTITION BY k, yr, o_orderstatus) AS p FROM ord)
GROUP BY k, yr, o_orderstatus, p"""),
    "lin": (["ord"], "SELECT * FROM lineitem JOIN ord ON o_orderkey = l_orderkey"),
    "elm": (["lin"], f"""
SELECT {_SNAP}, o_orderstatus AS orbit_id, 'J2000' AS equinox, {_case(ELEMENT_BY_LINE, 'l_linenumber')} AS element_name,
  max(l_extendedprice) / 1e4 AS element_value FROM lin GROUP BY k, yr, o_orderstatus, l_linenumber"""),
    "phy": (["lin"], f"""
SELECT {_SNAP}, nm AS param_name, CASE WHEN nm <> 'extent' THEN max(l_quantity) END AS param_value_numeric
FROM (SELECT *, {_case(PARAMETER_BY_FLAGS, "l_returnflag || l_linestatus")} AS nm FROM lin) GROUP BY k, yr, nm"""),
    # --- resolution: hub, alias lists, evaluations, quarantine -----------------------------------
    "hub": (["cat"], "SELECT DISTINCT spkid AS raw, nullif(trim(spkid), '') AS spk, trim(designation) AS des, trim(fullname) AS fnm FROM cat"),
    "ali": (["hub", "cat"], f"""
SELECT DISTINCT 'des' AS kind, {norm('des')} AS alias, spk, des, fnm FROM hub WHERE spk IS NOT NULL
UNION ALL SELECT DISTINCT 'fullname', {norm('fnm')}, spk, des, fnm FROM hub WHERE spk IS NOT NULL
UNION ALL SELECT DISTINCT 'alternate', a, spk, des, '' FROM (
  SELECT {norm('x')} AS a, nullif(trim(spkid), '') AS spk, trim(designation) AS des FROM (SELECT spkid, designation, unnest(alternate_designations) AS x FROM cat))
  WHERE spk IS NOT NULL AND a <> {norm('des')}"""),
    "ald": (["ali"], """
SELECT alias, count(*) AS n, min(spk) AS spk, max(des) AS des, list(spk ORDER BY spk) AS ids FROM ali WHERE kind = 'des' GROUP BY alias"""),
    "alo": (["ali"], """
SELECT alias, count(DISTINCT spk) AS n, max(spk) AS spk, max(des) AS des, bool_or(kind = 'fullname') AS isf,
  list_sort(list(DISTINCT spk)) AS ids FROM ali WHERE kind <> 'des' GROUP BY alias"""),
    "fd1": (["apr"], f"""
SELECT DISTINCT id AS raw, nullif(trim(id), '') AS i, trim(name) AS name, nullif({norm('name')}, '') AS alias FROM apr"""),
    "fd3": (["rsk"], f"""
SELECT DISTINCT sentry_id AS i, nullif(trim(designation), '') AS des, designation AS raw_des, trim(fullname) AS fnm,
  {norm('designation')} AS alias FROM rsk"""),
    "dir": (["hub"], "SELECT spk FROM hub WHERE spk IS NOT NULL GROUP BY spk HAVING count(DISTINCT coalesce(des, '?')) = 1"),
    "ev1": (["fd1", "dir", "ald", "alo"], f"""
SELECT f.*, d.spk IS NOT NULL AS direct, a.n AS dn, a.ids AS dids, len(list_filter(a.ids, lambda s: s <> f.i)) > 0 AS other,
  CASE WHEN a.n > 0 THEN a.n ELSE coalesce(o.n, 0) END AS n, CASE WHEN a.n > 0 THEN a.spk ELSE o.spk END AS spk,
  CASE WHEN a.n > 0 THEN a.des ELSE o.des END AS des, CASE WHEN a.n > 0 THEN a.ids ELSE o.ids END AS ids,
  CASE WHEN a.n > 0 THEN NULL WHEN o.isf THEN 'fullname' ELSE 'alternate_designation' END AS field,
  CASE WHEN a.n > 0 THEN '{R.V.EXACT_DESIGNATION}' WHEN o.isf THEN '{R.V.EXACT_FULLNAME}' ELSE '{R.V.ALTERNATE_DESIGNATION}' END AS rule
FROM fd1 f LEFT JOIN dir d ON d.spk = f.i LEFT JOIN ald a ON a.alias = f.alias LEFT JOIN alo o ON o.alias = f.alias
WHERE f.i IS NOT NULL"""),
    "ev3": (["fd3", "ald"], "SELECT f.*, coalesce(a.n, 0) AS n, a.spk, a.des AS hub_des, a.ids FROM fd3 f LEFT JOIN ald a USING (alias) WHERE f.des IS NOT NULL"),
}


def _evaluations() -> str:
    n = "NULL"
    parts = [
        _audit("sbdb", "spkid", "coalesce(raw, '')", n, "", n, "INVALID", f"'{R.V.INVALID_IDENTIFIER}'",
               proof(error=_lit(R.NO_CATALOG_ID))) + " FROM hub WHERE spk IS NULL",
        _audit("sbdb", "spkid", "spk", "spk", "spkid", "spk", "RESOLVED", f"'{R.V.PIVOT}'",
               proof(pivot=_lit("canonical_external_pivot"), spkid=jtext("spk"), fullname=jtext("fnm"))) + " FROM hub WHERE spk IS NOT NULL",
        _audit("sbdb", "des", "des", "spk", "spkid", "spk", "RESOLVED", f"'{R.V.CATALOG_DESIGNATION}'",
               proof(associated_with_spkid=jtext("spk"), fullname=jtext("fnm"))) + " FROM hub WHERE spk IS NOT NULL AND des <> ''",
        _audit("neows", "id", "raw", n, "", n, "INVALID", f"'{R.V.INVALID_IDENTIFIER}'",
               proof(error=_lit(R.NO_APPROACH_ID))) + " FROM fd1 WHERE i IS NULL",
        _audit("neows", "id", "i", "i", "spkid", n, "AMBIGUOUS", f"'{R.V.CONTRADICTION}'",
               proof(error=_lit(R.CONTRADICTORY), id_spkid=jtext("i"), name=jtext("name"), normalized_designation=jtext("alias"),
                     candidate_count="dn::VARCHAR")) + " FROM ev1 WHERE direct AND coalesce(other, false)",
        _audit("neows", "id", "i", "i", "spkid", "i", "RESOLVED", f"'{R.V.EXACT_SPKID}'",
               proof(matched_spkid=jtext("i"), pivot_match=_lit("exact_spkid"), name=jtext("name")))
        + " FROM ev1 WHERE direct AND NOT coalesce(other, false)",
        _audit("neows", "id", "i", "des", "des", "spk", "RESOLVED", "rule",
               proof(matched_sbdb_des=jtext("des"), matched_spkid=jtext("spk"), name=jtext("name"), normalized_designation=jtext("alias"),
                     resolution_rule=jtext("rule"), matched_sbdb_field=jtext("field"))) + " FROM ev1 WHERE NOT direct AND n = 1",
        _audit("neows", "id", "i", "alias", "des", n, "AMBIGUOUS", f"'{R.V.COLLISION}'",
               proof(error=_lit(R.APPROACH_COLLISION), name=jtext("name"), normalized_designation=jtext("alias"),
                     matched_sbdb_field=jtext("field"), candidate_count="n::VARCHAR"))
        + " FROM ev1 WHERE NOT direct AND n > 1",
        _audit("neows", "id", "i", n, "", n, "UNRESOLVED", f"'{R.V.NO_MATCH}'",
               proof(reason=_lit(R.APPROACH_UNMATCHED), name=jtext("name"), normalized_designation=jtext("alias")))
        + " FROM ev1 WHERE NOT direct AND n = 0",
        _audit("sentry", "des", "coalesce(raw_des, '')", n, "", n, "INVALID", f"'{R.V.INVALID_IDENTIFIER}'",
               proof(error=_lit(R.NO_RISK_DESIGNATION))) + " FROM fd3 WHERE des IS NULL",
        _audit("sentry", "des", "des", "hub_des", "des", "spk", "RESOLVED", f"'{R.V.EXACT_DESIGNATION}'",
               proof(matched_sbdb_des=jtext("hub_des"), matched_spkid=jtext("spk"), normalized_designation=jtext("alias"),
                     fullname=jtext("fnm"))) + " FROM ev3 WHERE n = 1",
        _audit("sentry", "sentry_id", "i", "hub_des", "des", "spk", "RESOLVED", f"'{R.V.RISK_ID_BY_DESIGNATION}'",
               proof(associated_via_sentry_des=jtext("des"), matched_spkid=jtext("spk"), fullname=jtext("fnm"))) + " FROM ev3 WHERE n = 1",
        _audit("sentry", "des", "des", "des", "des", n, "AMBIGUOUS", f"'{R.V.COLLISION}'",
               proof(error=_lit(R.RISK_COLLISION), normalized_designation=jtext("alias"), fullname=jtext("fnm"),
                     candidate_count="n::VARCHAR")) + " FROM ev3 WHERE n > 1",
        _audit("sentry", "sentry_id", "i", "des", "des", n, "AMBIGUOUS", f"'{R.V.COLLISION}'",
               proof(error=_lit(R.RISK_ID_COLLISION), normalized_designation=jtext("alias"), fullname=jtext("fnm"),
                     candidate_count="n::VARCHAR")) + " FROM ev3 WHERE n > 1",
        _audit("sentry", "des", "des", n, "", n, "UNRESOLVED", f"'{R.V.NO_MATCH}'",
               proof(reason=_lit(R.RISK_UNMATCHED), normalized=jtext("alias"), fullname=jtext("fnm"))) + " FROM ev3 WHERE n = 0",
        _audit("sentry", "sentry_id", "i", n, "", n, "UNRESOLVED", f"'{R.V.NO_MATCH}'",
               proof(reason=_lit(R.RISK_ID_UNMATCHED), designation=jtext("des"), fullname=jtext("fnm"))) + " FROM ev3 WHERE n = 0",
    ]
    return "\nUNION ALL ".join(parts)


TABLES["evl"] = (["hub", "fd1", "ev1", "fd3", "ev3"], _evaluations())
TABLES["fin"] = (["evl"], f"""
SELECT sys, nm, val, count(DISTINCT ky) AS nkeys, min(ky) AS ky,
  arg_max(st, (sev, st, rl, tsys, tnm, tval, ev)) AS st, arg_max(rl, (sev, st, rl, tsys, tnm, tval, ev)) AS rl,
  arg_max(coalesce(tsys, chr(1)), (sev, st, rl, tsys, tnm, tval, ev)) AS tsys,
  arg_max(coalesce(tnm, chr(1)), (sev, st, rl, tsys, tnm, tval, ev)) AS tnm,
  arg_max(coalesce(tval, chr(1)), (sev, st, rl, tsys, tnm, tval, ev)) AS tval, arg_max(ev, (sev, st, rl, tsys, tnm, tval, ev)) AS ev,
  {proof(error=_lit(R.COMPETING_KEYS), candidate_count="count(DISTINCT ky)::VARCHAR")} AS clash
FROM (SELECT *, CASE WHEN spk IS NOT NULL THEN {key_of('spk')} END AS ky,
        CASE st WHEN 'RESOLVED' THEN 1 WHEN 'UNRESOLVED' THEN 2 WHEN 'INVALID' THEN 3 ELSE 4 END AS sev FROM evl)
GROUP BY sys, nm, val""")
TABLES["clk"] = (["ev1", "ev3", "evl", "fin"], f"""
SELECT 'neows' AS source_system, 'id' AS identifier_name, i AS source_identifier_value, 'CONTRADICTORY_CANDIDATE_QUARANTINE' AS kind, alias,
  NULL::VARCHAR AS candidate_key FROM ev1 WHERE direct AND coalesce(other, false)
UNION SELECT 'neows', 'id', i, 'DUPLICATE_COLLISION_QUARANTINE', alias, NULL FROM ev1 WHERE NOT direct AND n > 1
UNION SELECT 'sentry', 'des', des, 'DUPLICATE_COLLISION_QUARANTINE', alias, NULL FROM ev3 WHERE n > 1
UNION SELECT 'sentry', 'sentry_id', i, 'DUPLICATE_COLLISION_QUARANTINE', alias, NULL FROM ev3 WHERE n > 1
UNION SELECT e.sys, e.nm, e.val, 'COMPETING_KEYS', NULL, {key_of('e.spk')} FROM evl e JOIN fin f
  ON f.sys = e.sys AND f.nm = e.nm AND f.val = e.val AND f.nkeys > 1 WHERE e.spk IS NOT NULL""")
TABLES["aud"] = (["fin"], f"""
SELECT '{RUN_ID}' AS resolution_run_id, '{RESOLVED_AT}' AS resolved_at, sys AS source_system, nm AS identifier_name,
  val AS source_identifier_value, nullif(tsys, chr(1)) AS matched_target_system, nullif(tnm, chr(1)) AS matched_target_identifier_name,
  nullif(tval, chr(1)) AS matched_target_identifier_value,
  CASE WHEN nkeys = 1 AND st = 'RESOLVED' THEN ky END AS assigned_asteroid_key,
  CASE WHEN nkeys > 1 THEN 'AMBIGUOUS' ELSE st END AS match_state, CASE WHEN nkeys > 1 THEN '{R.V.COLLISION}' ELSE rl END AS match_rule,
  CASE WHEN nkeys > 1 THEN clash ELSE ev END AS evidence_json FROM fin""")
TABLES["brg"] = (["fin"], f"""
SELECT ky AS asteroid_key, sys AS source_system, nm AS identifier_name, val AS identifier_value,
  sys = 'sbdb' AND nm = 'spkid' AS is_primary_pivot, '{RESOLVED_AT}' AS created_at, '{RESOLVED_AT}' AS updated_at FROM fin WHERE nkeys = 1""")
TABLES["cov"] = (["rsk"], """
SELECT snapshot_key, true AS is_captured, count(*) AS row_count, min(snapshot_time) AS first_snapshot_time,
  max(snapshot_time) AS last_snapshot_time, rank() OVER (ORDER BY snapshot_key) AS snapshot_seq FROM rsk GROUP BY snapshot_key""")
_METRICS = ["impact_probability", "palermo_scale_max", "palermo_scale_cum", "torino_scale_max", "potential_impacts_count",
            "v_infinity_km_s", "last_obs_date"]
TABLES["lif"] = (["rsk", "brg"], f"""
SELECT r.*, k.n AS nk, CASE WHEN k.n = 1 THEN k.ky END AS asteroid_key FROM (
SELECT sentry_id, last(designation ORDER BY snapshot_key) AS designation, last(fullname ORDER BY snapshot_key) AS fullname,
  min(snapshot_key) AS first_snapshot_key, first(snapshot_time ORDER BY snapshot_key) AS first_snapshot_time,
  max(snapshot_key) AS last_snapshot_key, last(snapshot_time ORDER BY snapshot_key) AS last_snapshot_time,
  count(DISTINCT snapshot_key) AS total_snapshots_observed, last(impact_year_range ORDER BY snapshot_key) AS yrange,
  {', '.join(f"first({m} ORDER BY snapshot_key) AS initial_{m}, last({m} ORDER BY snapshot_key) AS latest_{m}" for m in _METRICS)},
  {', '.join(f"first({m} ORDER BY snapshot_key) FILTER ({m} IS NOT NULL) AS initial_{m}, last({m} ORDER BY snapshot_key) FILTER ({m} IS NOT NULL) AS latest_{m}" for m in ("estimated_diameter_km", "absolute_magnitude"))},
  {', '.join(f"max({m}) AS all_time_max_{m}" for m in _METRICS[:5])}
FROM rsk GROUP BY sentry_id) r
LEFT JOIN (SELECT identifier_value AS sid, count(DISTINCT asteroid_key) AS n, min(asteroid_key) AS ky FROM brg
  WHERE source_system = 'sentry' AND identifier_name = 'sentry_id' GROUP BY 1) k ON k.sid = r.sentry_id""")
TABLES["now"] = (["rsk"], f"""
SELECT max(snapshot_key) AS gk, date_sub('hour', max((snapshot_key, snapshot_time))[2]::TIMESTAMP, TIMESTAMP '{AS_OF[:19].replace('T', ' ')}') > 48 AS stale FROM rsk""")
TABLES["rbe"] = (["lif", "now"], """
SELECT asteroid_key, count(*) AS n, CASE WHEN count(*) = 1 THEN max(sentry_id) END AS sid,
  CASE WHEN count(*) = 1 THEN max(latest_impact_probability) END AS ip, CASE WHEN count(*) = 1 THEN max(latest_palermo_scale_max) END AS pm,
  CASE WHEN count(*) = 1 THEN max(latest_torino_scale_max) END AS tm, CASE WHEN count(*) = 1 THEN max(latest_potential_impacts_count) END AS pc,
  CASE WHEN count(*) = 1 THEN max(yrange) END AS yr, CASE WHEN count(*) = 1 AND NOT any_value(stale) THEN bool_or(last_snapshot_key = gk) END AS act,
  max(total_snapshots_observed) AS obs, max(all_time_max_impact_probability) AS aip, max(all_time_max_palermo_scale_max) AS apm,
  max(all_time_max_torino_scale_max) AS atm, bool_or(nk > 1) AS crossed
FROM lif, now WHERE asteroid_key IS NOT NULL GROUP BY asteroid_key""")
TABLES["chp"] = (["cat", "orb", "elm", "phy", "brg"], """
SELECT o.spkid, b.ky AS asteroid_key, o.designation, o.fullname, o.shortname, o.object_kind, o.is_neo, o.is_pha, o.orbit_class_code,
  o.orbit_class_name, o.orbit_id, r.epoch_jd, r.soln_date, r.data_arc_days, r.n_obs_used, r.condition_code, r.rms, r.earth_moid_au,
  r.jupiter_moid_au, r.t_jup, e.ec AS eccentricity, e.a AS semi_major_axis_au, e.q AS perihelion_distance_au, e.i AS inclination_deg,
  CASE WHEN e.a > 0 THEN round(e.a ** 1.5, 9) END AS orbital_period_yr, p.d AS estimated_diameter_km, p.h AS absolute_magnitude,
  p.al AS albedo, p.ro AS rotational_period_hr,
  CASE WHEN coalesce(r.data_arc_days::VARCHAR, r.n_obs_used::VARCHAR, r.condition_code) IS NULL THEN 'UNREPORTED'
    WHEN TRY_CAST(r.condition_code AS INT) < 5 AND r.data_arc_days >= 30 AND r.n_obs_used >= 20 THEN 'ADEQUATELY_CONSTRAINED'
    ELSE 'FOLLOWUP_PRIORITY_LIMITED_ARC' END AS astrometric_data_quality_tier
FROM (SELECT * FROM cat QUALIFY row_number() OVER (PARTITION BY spkid ORDER BY (snapshot_key, snapshot_time, run_id, designation, fullname, shortname, object_kind, is_neo, is_pha, orbit_class_code, orbit_class_name, orbit_id) DESC) = 1) o
LEFT JOIN (SELECT * FROM orb QUALIFY row_number() OVER (PARTITION BY spkid ORDER BY snapshot_key DESC, snapshot_time DESC, run_id DESC, orbit_id DESC) = 1) r USING (spkid)
LEFT JOIN (SELECT spkid, max(element_value) FILTER (element_name = 'e') AS ec, max(element_value) FILTER (element_name = 'a') AS a,
  max(element_value) FILTER (element_name = 'q') AS q, max(element_value) FILTER (element_name = 'i') AS i FROM elm GROUP BY spkid) e USING (spkid)
LEFT JOIN (SELECT spkid, max(param_value_numeric) FILTER (param_name = 'diameter') AS d, max(param_value_numeric) FILTER (param_name = 'H') AS h,
  max(param_value_numeric) FILTER (param_name = 'albedo') AS al, max(param_value_numeric) FILTER (param_name = 'rot_per') AS ro FROM phy GROUP BY spkid) p USING (spkid)
LEFT JOIN (SELECT identifier_value AS spkid, max(asteroid_key) AS ky FROM brg WHERE is_primary_pivot GROUP BY 1) b USING (spkid)""")
TABLES["anc"] = (["cat", "orb"], """
SELECT spkid, snapshot_key, run_id, snapshot_time FROM (
  SELECT spkid, snapshot_key, run_id, snapshot_time FROM cat UNION SELECT spkid, snapshot_key, run_id, snapshot_time FROM orb)
QUALIFY row_number() OVER (PARTITION BY spkid ORDER BY snapshot_key DESC, snapshot_time DESC, run_id DESC) = 1""")
TABLES["res"] = (["apr", "aud", "brg"], """
SELECT i.id AS neows_id,
  CASE WHEN NOT regexp_full_match(i.id, '[0-9]+') THEN 'INVALID'
    WHEN a.match_state = 'RESOLVED' AND a.assigned_asteroid_key IS NULL THEN 'UNRESOLVED' WHEN a.match_state IS NOT NULL THEN a.match_state
    WHEN b.n = 1 THEN 'RESOLVED' WHEN b.n > 1 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS match_state,
  CASE WHEN NOT regexp_full_match(i.id, '[0-9]+') THEN NULL WHEN a.match_state = 'RESOLVED' THEN a.assigned_asteroid_key
    WHEN a.match_state IS NULL AND b.n = 1 THEN b.ky END AS asteroid_key,
  CASE WHEN NOT regexp_full_match(i.id, '[0-9]+') THEN 'INVALID_SYNTAX' WHEN a.match_state IS NOT NULL THEN coalesce(a.match_rule, 'NO_CROSS_SOURCE_MATCH')
    WHEN b.n = 1 THEN 'BRIDGE_EXACT_NEOWS_ID' WHEN b.n > 1 THEN 'BRIDGE_MULTIPLE_CANDIDATE_KEYS' ELSE 'NO_RESOLUTION_RECORD' END AS match_rule,
  a.resolved_at, a.evidence_json
FROM (SELECT DISTINCT id FROM apr) i
LEFT JOIN (SELECT * FROM aud WHERE source_system = 'neows' AND identifier_name = 'id') a ON a.source_identifier_value = i.id
LEFT JOIN (SELECT identifier_value AS id, count(DISTINCT asteroid_key) AS n, min(asteroid_key) AS ky FROM brg
  WHERE source_system = 'neows' AND identifier_name = 'id' GROUP BY 1) b ON b.id = i.id""")
TABLES["lnk"] = (["brg"], """
SELECT asteroid_key, count(DISTINCT identifier_value) AS n, min(identifier_value) AS sid FROM brg
WHERE source_system = 'sentry' AND identifier_name = 'sentry_id' AND identifier_value <> '' GROUP BY 1""")
TABLES["pvt"] = (["brg"], "SELECT asteroid_key, max(identifier_value) AS spkid FROM brg WHERE is_primary_pivot GROUP BY 1")
TABLES["lrk"] = (["rsk"], "SELECT * FROM rsk QUALIFY row_number() OVER (PARTITION BY sentry_id ORDER BY snapshot_key DESC, snapshot_time DESC, run_id DESC) = 1")
TABLES["wls"] = (["apr", "res", "lnk", "pvt", "lrk", "cat"], """
SELECT n.closest_approach_date, n.id AS neows_id, n.name, n.miss_distance_km, n.miss_distance_km / 384400.0::DOUBLE AS miss_distance_lunar, n.hazardous,
  s.asteroid_key, s.match_state, coalesce(l.n, 0) > 0 AS is_sentry_monitored, coalesce(l.n, 0) > 1 AS is_sentry_ambiguous,
  CASE WHEN l.n = 1 THEN l.sid END AS sentry_id, r.impact_probability AS sentry_impact_probability, r.palermo_scale_max AS sentry_palermo_scale_max,
  r.torino_scale_max AS sentry_torino_scale_max, r.potential_impacts_count AS sentry_potential_impacts_count, r.impact_year_range AS sentry_impact_year_range,
  p.spkid IS NOT NULL AS has_sbdb_characterization, p.spkid AS sbdb_spkid, c.designation AS sbdb_designation, c.fullname AS sbdb_fullname,
  c.orbit_class_name AS sbdb_orbit_class_name
FROM (SELECT * FROM apr QUALIFY row_number() OVER (PARTITION BY id, closest_approach_date ORDER BY miss_distance_km, name NULLS LAST, hazardous NULLS LAST) = 1) n
JOIN res s ON s.neows_id = n.id LEFT JOIN lnk l ON l.asteroid_key = s.asteroid_key
LEFT JOIN lrk r ON l.n = 1 AND r.sentry_id = l.sid LEFT JOIN pvt p ON p.asteroid_key = s.asteroid_key
LEFT JOIN (SELECT * FROM cat QUALIFY row_number() OVER (PARTITION BY spkid ORDER BY snapshot_key DESC, snapshot_time DESC, run_id DESC, designation DESC, fullname DESC, orbit_class_name DESC) = 1) c
  ON c.spkid = p.spkid""")
_RISK_ASSESSMENT = ["designation", "fullname", "absolute_magnitude", "estimated_diameter_km", "impact_probability", "potential_impacts_count",
                    "palermo_scale_cum", "palermo_scale_max", "torino_scale_max", "v_infinity_km_s", "impact_year_range", "last_obs_date", "last_obs_jd"]
_OPTIONAL = ["close_approach_datetime", "close_approach_epoch_ms", "relative_velocity_km_s", "absolute_magnitude_h",
             "estimated_diameter_min_km", "estimated_diameter_max_km", "is_sentry_object"]
TABLES["wld"] = (["apr", "res", "lnk", "pvt", "lrk", "anc", "rsk"], f"""
SELECT n.id AS neows_id, n.name, n.closest_approach_date, n.miss_distance_km, n.hazardous, {', '.join('n.' + c for c in _OPTIONAL)},
  s.match_state, s.asteroid_key, s.match_rule, s.resolved_at, p.spkid AS sbdb_spkid, a.snapshot_key AS sbdb_snapshot_key, a.run_id AS sbdb_run_id,
  coalesce(l.n, 0) AS sentry_link_count, CASE WHEN l.n = 1 THEN l.sid END AS sentry_id, r.snapshot_key AS sentry_snapshot_key, r.run_id AS sentry_run_id,
  r.snapshot_time AS sentry_snapshot_time, {', '.join(f'r.{c} AS sentry_{c}' for c in _RISK_ASSESSMENT)},
  (SELECT max(snapshot_key) FROM rsk) AS sentry_latest_catalog_snapshot_key
FROM (SELECT * FROM apr QUALIFY row_number() OVER (PARTITION BY id ORDER BY miss_distance_km, closest_approach_date, name NULLS LAST, hazardous NULLS LAST) = 1) n
JOIN res s ON s.neows_id = n.id LEFT JOIN pvt p ON s.match_state = 'RESOLVED' AND p.asteroid_key = s.asteroid_key LEFT JOIN anc a ON a.spkid = p.spkid
LEFT JOIN lnk l ON s.match_state = 'RESOLVED' AND l.asteroid_key = s.asteroid_key LEFT JOIN lrk r ON l.n = 1 AND r.sentry_id = l.sid""")


def with_tables(body: str, *names: str) -> str:
    """`WITH` the named tables and their inputs, each once, inputs first."""
    done: list[str] = []

    def add(name: str) -> None:
        for needed in TABLES[name][0]:
            add(needed)
        if name not in done:
            done.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n][1]})" for n in done)
    return f"WITH {ctes}\n{body}" if done else body
