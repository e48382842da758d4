import uuid

import pytest
from pyspark.sql import functions as F

from perigee.functions import availability, dates, distance, keys, numbers, orbit, text
from perigee.vocabulary import KEY_NAMESPACE


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x")).alias("y")).collect()]


def test_squeeze_and_normalize(spark):
    assert values(spark, text.squeeze, ["  a \t\n b c ", None, ""]) == ["a b c", "", ""]
    raw = ["(2010 TW54)", " ( 2010  tw54 ) ", "433 Eros (A898 PA)", "((x))", "()", "(a) b", None]
    assert values(spark, text.normalize_designation, raw) == [
        "2010 TW54", "2010 TW54", "433 EROS (A898 PA)", "(X)", "", "(A) B", ""]


def test_redaction(spark):
    raw = ["http://x?api_key=abc&z=1", 'a "http://x?q=1&api_key=s" b', "no_api_key=1", None]
    assert values(spark, text.redact_api_key, raw) == [
        "http://x?api_key=REDACTED&z=1", 'a "http://x?q=1&api_key=REDACTED" b', "no_api_key=1", None]


def test_redaction_looks_at_what_stands_before_the_name(spark):
    raw = ["?api_key=", "?api_key=&api_key=x", "?api_key=a?api_key=b", "api_key=x", "&&api_key=x&api_key=y z", "?api_key=api_key=x", "?apiapi_key=x", "?api_key=é\u3000é", "?API_KEY=x"]
    assert values(spark, text.redact_api_key, raw) == [
        "?api_key=", "?api_key=&api_key=REDACTED", "?api_key=REDACTED", "api_key=x", "&&api_key=REDACTED&api_key=REDACTED z", "?api_key=REDACTED",
        "?apiapi_key=x", "?api_key=REDACTED\u3000é", "?API_KEY=x"]


def test_scrub_nested(spark):
    df = spark.sql("""select named_struct('Auth_Token', 't', 'keep', array(named_struct('u', 'x?api_key=1', 'secretId', 2)),
        'm', map('PASSWORD', 'p', 'ok', 'y?api_key=2')) as s""")
    out = df.select(text.scrub_struct(F.col("s"), df.schema["s"].dataType).alias("s")).first()["s"].asDict(recursive=True)
    assert out == {"keep": [{"u": "x?api_key=REDACTED"}], "m": {"ok": "y?api_key=REDACTED"}}


def test_entity_key_is_uuid5(spark):
    ids = ["54527277", " 2000433 ", "x é"]
    want = [f"ast_{uuid.uuid5(uuid.UUID(KEY_NAMESPACE), 'spk:' + i.strip())}" for i in ids]
    got = values(spark, keys.entity_key, ids)
    assert got == want
    assert got[0] == "ast_c43b711d-1749-52e9-bac5-1ba300e47e63"
    assert values(spark, keys.is_entity_key, [got[0].upper().replace("AST_", "ast_"), "ast_1", got[0].replace("-5", "-4", 1)]) == [True, False, False]


def test_unit_direction_is_on_the_sphere(spark):
    for d in values(spark, keys.unit_direction, ["3713318", "1", ""]):
        assert abs(d.x**2 + d.y**2 + d.z**2 - 1) < 1e-12


def test_strict_numbers(spark):
    raw = ["1.5", " .5 ", "-2e3", "1d", "1_000", "NaN", "inf", "", None, "1e999", "5."]
    assert values(spark, numbers.to_double, raw) == [1.5, 0.5, -2000.0, None, None, None, None, None, None, None, 5.0]
    assert values(spark, numbers.to_bigint, ["3", " +4", "3.7", "", "x", "99999999999999999999"]) == [3, 4, None, None, None, None]


def test_dates(spark):
    raw = ["2026-09-29", " 2026-09-29 ", "2026-9-1", "2026-02-30", "2026-13-01", "x", None]
    assert values(spark, dates.iso_date, raw) == ["2026-09-29", "2026-09-29", None, None, None, None, None]
    raw = ["2026-Sep-29 07:18", "2026-Sept-29 07:18", "soon", None]
    assert values(spark, dates.approach_datetime, raw) == ["2026-09-29T07:18", None, None, None]
    path = values(spark, lambda c: dates.run_document_path(c, F.lit(" r1 ")), ["2026-09-05T10:00:00Z", "2026-01-31"])
    assert path == ["metadata/pipeline_runs/year=2026/month=09/day=05/run_manifest_r1.json",
                    "metadata/pipeline_runs/year=2026/month=01/day=31/run_manifest_r1.json"]


def test_quality_tier(spark):
    rows = [(None, None, None), (3844, 150, "1"), (29, 150, "1"), (30, 20, "4"), (30, 20, "5"), (30, 20, "E"), (None, 20, "1"), (30, 19, "0")]
    df = spark.createDataFrame(rows, "a bigint, n bigint, c string")
    got = [r[0] for r in df.select(orbit.quality_tier(F.col("a"), F.col("n"), F.col("c"))).collect()]
    limited = "FOLLOWUP_PRIORITY_LIMITED_ARC"
    assert got == ["UNREPORTED", "ADEQUATELY_CONSTRAINED", limited, "ADEQUATELY_CONSTRAINED", limited, limited, limited, limited]


def test_distance_scale_is_monotonic_and_invertible(spark):
    kms = [1.0, 6371.0, 100_000.0, 384_400.0, 384_401.0, 999_999.0, 1e6, 47_382_615.0, 1e8]
    heights = values(spark, lambda c: distance.height(c, 160.0, 220.0, 120.0), kms, "double")
    assert heights == sorted(heights) and len(set(heights)) == len(heights)
    assert heights[3] == pytest.approx(160) and heights[6] == pytest.approx(220)
    assert values(spark, lambda c: distance.height(c, 1.0, 2.0, 3.0), [0.0, -1.0], "double") == [None, None]
    ps = [0.0, 0.01, 0.16, 0.2, 0.22, 0.5, 1.0]
    back = values(spark, lambda c: distance.progress_at(distance.revealed_km(c, F.lit(1e8)), F.lit(1e8)), ps, "double")
    assert back == pytest.approx(ps)
    assert values(spark, distance.domain_maximum, [None, 5e7, 1.2e8], "double") == [1e8, 1e8, 1.3e8]
    assert values(spark, distance.band_tier, [10, 5, 7], "bigint") == ["major", "mid", "minor"]
    assert values(spark, distance.frontier_label, [47_382_615.0, 384_400.0], "double") == [47_000_000.0, 380_000.0]


def test_section_availability(spark):
    df = spark.sql("select 1 as a, cast(null as int) as b, cast(null as int) as c, array('c') as older, cast(null as string) as why")
    cols = {c: F.col(c) for c in "abc"}
    block = df.select(availability.section(cols, F.col("why"), F.col("older")).alias("s")).first()["s"]
    assert block.status == "partial" and block.unavailable == {"b": "not_in_source", "c": "not_in_current_contract"}
    none = df.select(availability.section({"b": F.col("b")}, F.lit("not_resolved")).alias("s")).first()["s"]
    assert none.status == "unavailable" and none.unavailable == {"b": "not_resolved"}
    assert df.select(availability.section({"a": F.col("a")}, F.col("why")).alias("s")).first()["s"].status == "available"


def test_dominant_reason_ties_go_to_the_earliest(spark):
    m = spark.sql("select map('a', 'x', 'b', 'y', 'c', 'y', 'd', 'x') as m, map('a', 'z', 'b', 'y', 'c', 'y') as n, cast(map() as map<string,string>) as e")
    r = m.select(*[availability.dominant_reason(F.col(c)).alias(c) for c in "mne"]).first()
    assert (r.m, r.n, r.e) == ("x", "y", None)
