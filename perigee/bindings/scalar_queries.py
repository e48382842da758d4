"""Scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.bindings import domain as D
from perigee.bindings.registry import query
from perigee.bindings.sql import key_of
from perigee.functions import dates, keys, numbers, orbit, text
from perigee.vocabulary import DIRECTION_SALT

# Upper case of a sharp s is two letters here and in the JVM, one in the check engine.
_UPPER = "replace(upper(replace({}, 'ß', 'SS')), 'ẞ', 'SS')"
_SQUEEZED = "regexp_replace(regexp_replace(regexp_replace({}, '\\s+', ' ', 'g'), '^ ', ''), ' $', '')"


@query("squeezed_documents", "F1", f"SELECT doc_id, md5({_SQUEEZED.format('text')}) AS digest, length({_SQUEEZED.format('text')}) AS n FROM documents")
def _(spark, sf):
    squeezed = text.squeeze(F.col("text"))
    return D.table(spark, sf, "documents").select("doc_id", F.md5(squeezed).alias("digest"), F.length(squeezed).cast("bigint").alias("n"))


@query("normalized_turns", "F2", f"""
SELECT conv_id, turn, md5({_UPPER.format(_SQUEEZED.format('text'))}) AS digest FROM conversations""")
def _(spark, sf):
    wrapped = F.concat(F.lit(" ( "), F.col("text"), F.lit(" )  "))
    return D.table(spark, sf, "conversations").select("conv_id", "turn", F.md5(text.normalize_designation(wrapped)).alias("digest"))


@query("redacted_pages", "F6 K6", """
SELECT page_id, regexp_replace(url || '&api_key=k' || page_id || '&z=1', '([?&]api_key=)[^&"''\\s]+', '\\1REDACTED', 'g') AS url,
  md5(regexp_replace(replace(html, 'href="', 'href="/go?api_key='), '([?&]api_key=)[^&"''\\s]+', '\\1REDACTED', 'g')) AS html_digest FROM pages""")
def _(spark, sf):
    linked = F.concat("url", F.lit("&api_key=k"), F.col("page_id").cast("string"), F.lit("&z=1"))
    keyed = F.replace("html", F.lit('href="'), F.lit('href="/go?api_key='))
    return D.table(spark, sf, "pages").select(
        "page_id", text.redact_api_key(linked).alias("url"), F.md5(text.redact_api_key(keyed)).alias("html_digest"))


@query("scrubbed_properties", "F7", """
SELECT event_id, 'k=' || json_extract_string(props, '$.k') || ',url=http://x?api_key=REDACTED' AS kept FROM events""")
def _(spark, sf):
    props = F.from_json("props", "map<string,string>")
    noisy = F.map_concat(props, F.create_map(
        F.lit("url"), F.lit("http://x?api_key=s3cret"), F.lit(" X-Auth-Token "), F.lit("t"), F.lit("db_PASSWORD"), F.lit("p")))
    kept = F.array_sort(F.transform(F.map_entries(text.scrub_map(noisy)), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return D.table(spark, sf, "events").select("event_id", F.array_join(kept, ",").alias("kept"))


@query("scrubbed_structs", "F7", """
SELECT doc_id, '{"meta":{"n":' || n_chars || ',"urls":["u?api_key=REDACTED"]},"source":"' || source || '"}' AS kept FROM documents""")
def _(spark, sf):
    docs = D.table(spark, sf, "documents").select("doc_id", F.struct(
        F.struct(F.col("n_chars").alias("n"), F.array(F.concat(F.lit("u?api_key="), "lang")).alias("urls"),
                 F.col("lang").alias("access_token")).alias("meta"),
        F.col("source"), F.col("lang").alias("Password")).alias("s"))
    return docs.select("doc_id", F.to_json(text.scrub_struct(F.col("s"), docs.schema["s"].dataType)).alias("kept"))


@query("entity_keys", "F3 F4", f"""
SELECT c_custkey, {key_of("('20' || c_custkey)")} AS asteroid_key, true AS is_key, false AS name_is_key FROM customer""")
def _(spark, sf):
    key = keys.entity_key(F.concat(F.lit(" 20"), F.col("c_custkey").cast("string"), F.lit(" ")))
    return D.table(spark, sf, "customer").select(
        "c_custkey", key.alias("asteroid_key"), keys.is_entity_key(key).alias("is_key"), keys.is_entity_key(F.col("c_name")).alias("name_is_key"))


_U = "('0x' || substr(sha256('" + DIRECTION_SALT + "' || event_id), {}, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE"


@query("unit_directions", "F24", f"""
SELECT event_id, round(sqrt(greatest(0, 1 - z * z)) * cos(phi), 9) AS x, round(sqrt(greatest(0, 1 - z * z)) * sin(phi), 9) AS y, round(z, 9) AS z
FROM (SELECT event_id, 1 - 2 * ({_U.format(1)}) AS z, 2 * pi() * ({_U.format(17)}) AS phi FROM events)""")
def _(spark, sf):
    d = keys.unit_direction(F.col("event_id").cast("string"))
    return D.table(spark, sf, "events").select("event_id", *[F.round(d[c], 9).alias(c) for c in "xyz"])


@query("strict_numbers", "F5 F31", """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN value END AS number, CASE WHEN event_id % 5 = 0 AND value > 100 THEN value END AS above_100,
  CASE WHEN event_id % 5 = 4 THEN floor(value)::BIGINT END AS whole, CASE WHEN event_id % 5 <> 0 THEN value END AS not_nan,
  CASE event_id % 4 WHEN 0 THEN 1e100 WHEN 1 THEN 1e308 WHEN 2 THEN 1e200 END AS large FROM events""")
def _(spark, sf):
    v = F.col("value").cast("string")
    kind = F.col("event_id") % 5
    written = F.when(kind == 0, v).when(kind == 1, F.concat(F.lit(" "), v, F.lit(" "))).when(kind == 2, F.concat(v, F.lit("d"))).when(
        kind == 3, "NaN").otherwise(F.concat(F.floor("value").cast("string"), F.lit("_0")))
    whole = F.when(kind == 4, F.concat(F.lit("+"), F.floor("value").cast("string"))).otherwise(F.concat(F.floor("value").cast("string"), F.lit(".5")))
    number = numbers.to_double(written)
    maybe_nan = F.when(kind == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    turn = F.col("event_id") % 4
    large = F.when(turn == 0, "1e100").when(turn == 1, "1E+308").when(turn == 2, "1" + "0" * 200).otherwise("1e400")
    return D.table(spark, sf, "events").select(
        "event_id", numbers.to_double(large).alias("large"), number.alias("number"), numbers.above(F.when(kind == 0, number), 100.0).alias("above_100"),
        numbers.to_bigint(whole).alias("whole"), numbers.nan_to_null(maybe_nan).alias("not_nan"))


@query("date_functions", "F8 F12 F13 F32", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS approach, date_diff('day', DATE '2024-01-01', ts::DATE) AS days, date_sub('hour', TIMESTAMP '2024-01-01', ts) AS hours,
  'metadata/pipeline_runs/year=' || strftime(ts, '%Y/month=%m/day=%d') || '/run_manifest_' || event_id || '.json' AS path,
  CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END AS strict_date FROM events""")
def _(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd")
    kind = F.col("event_id") % 3
    loose = F.when(kind == 0, iso).when(kind == 1, F.concat(iso, F.lit("x"))).otherwise("2024-02-30")
    return D.table(spark, sf, "events").select(
        "event_id", dates.approach_datetime(F.date_format("ts", "yyyy-MMM-dd HH:mm")).alias("approach"),
        dates.days_between(F.lit("2024-01-01"), iso).alias("days"),
        dates.hours_between(F.lit("2024-01-01").cast("timestamp"), F.col("ts").cast("timestamp")).alias("hours"),
        dates.run_document_path(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_id").cast("string")).alias("path"),
        dates.iso_date(loose).alias("strict_date"))


@query("orbit_scalars", "F9 F10 F11", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 384400.0::DOUBLE AS lunar, round((l_quantity - 5) ** 1.5, 9) AS by_axis, l_quantity / 365.25::DOUBLE AS by_days,
  CASE WHEN l_returnflag = 'N' THEN 'UNREPORTED' WHEN l_linenumber < 5 AND l_quantity >= 30 THEN 'ADEQUATELY_CONSTRAINED' ELSE 'FOLLOWUP_PRIORITY_LIMITED_ARC' END AS tier
FROM lineitem WHERE l_quantity > 5
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 384400.0::DOUBLE, NULL, l_quantity / 365.25::DOUBLE,
  CASE WHEN l_returnflag = 'N' THEN 'UNREPORTED' ELSE 'FOLLOWUP_PRIORITY_LIMITED_ARC' END FROM lineitem WHERE l_quantity <= 5""")
def _(spark, sf):
    known = F.col("l_returnflag") != "N"
    code = F.when(known, F.col("l_linenumber").cast("string"))
    arc, seen = F.when(known, F.col("l_quantity").cast("bigint")), F.when(known, F.lit(20))
    return D.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", orbit.lunar_distances(F.col("l_extendedprice")).alias("lunar"),
        F.round(orbit.period_from_axis(F.col("l_quantity") - 5), 9).alias("by_axis"), orbit.period_from_days(F.col("l_quantity")).alias("by_days"),
        orbit.quality_tier(arc, seen, code).alias("tier"))
