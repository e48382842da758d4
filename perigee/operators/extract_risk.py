"""Risk records to snapshot rows: bounds on every published value, first copy wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.functions.dates import iso_date
from perigee.functions.numbers import to_bigint, to_double
from perigee.functions.text import blank_to_null, strip
from perigee.operators.picking import first_by
from perigee.runtime import pinned
from perigee.schemas import table_columns


RECORD_TEXT = (
    "id string, des string, fullname string, h string, diameter string, ip string, n_imp string, ps_cum string, "
    "ps_max string, ts_max string, v_inf string, `range` string, last_obs string, last_obs_jd string"
)
# A count may be a JSON number, which is cut to its whole part; as text it must be whole already.
RECORD_NUMBERS = "n_imp double, ts_max double"
# Few digits read alike as text and as a number; a record is only parsed for its numbers if a count is written otherwise.
_PLAIN = "^[0-9]{1,15}$"


def risk_fields(t: Column, record: Column) -> dict[str, Column]:
    designation = strip(t["des"])
    number = F.from_json(record, RECORD_NUMBERS)
    whole = lambda name: F.when(t[name].rlike(_PLAIN), t[name].cast("bigint")).otherwise(
        F.coalesce(number[name].cast("bigint"), to_bigint(t[name])))
    return {
        "sentry_id": strip(t["id"]),
        "designation": designation,
        "fullname": F.coalesce(strip(t["fullname"]), designation),
        "absolute_magnitude": to_double(t["h"]),
        "estimated_diameter_km": to_double(t["diameter"]),
        "impact_probability": to_double(t["ip"]),
        "potential_impacts_count": whole("n_imp"),
        "palermo_scale_cum": to_double(t["ps_cum"]),
        "palermo_scale_max": to_double(t["ps_max"]),
        "torino_scale_max": whole("ts_max"),
        "v_infinity_km_s": to_double(t["v_inf"]),
        "impact_year_range": F.coalesce(strip(t["range"]), F.lit("")),
        "last_obs_date": iso_date(t["last_obs"]),
        "last_obs_jd": to_double(t["last_obs_jd"]),
    }


def _written(t: Column) -> dict[str, Column]:
    """Which optional numbers hold any text: blank reads as NULL, text that is no number is malformed."""
    return {f"wrote_{name}": blank_to_null(t[name]).isNotNull() for name in ("h", "diameter", "last_obs_jd")}


def _defect() -> Column:
    def outside(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    ip, impacts = F.col("impact_probability"), F.col("potential_impacts_count")
    return (
        F.when(outside((F.col("sentry_id") != "") & (F.col("designation") != "")), "missing_identifier")
        .when(outside((ip > 0) & (ip <= 1)), "impact_probability")
        .when(outside(impacts >= 1), "potential_impacts_count")
        .when(F.col("palermo_scale_cum").isNull() | F.col("palermo_scale_max").isNull(), "palermo_scale")
        .when(outside(F.col("torino_scale_max") >= 0), "torino_scale")
        .when(outside(F.col("v_infinity_km_s") >= 0), "v_infinity")
        .when(F.col("last_obs_date").isNull(), "last_obs")
        .when(F.col("wrote_h") & F.col("absolute_magnitude").isNull(), "absolute_magnitude")
        .when(F.col("wrote_diameter") & F.col("estimated_diameter_km").isNull(), "estimated_diameter")
        .when(F.col("wrote_last_obs_jd") & F.col("last_obs_jd").isNull(), "last_obs_jd")
    )


def judge_risk(records: DataFrame, scope: list[str]) -> DataFrame:
    """All records with their fields and `reject_reason`; rows of silent payloads keep their `defect`."""
    marks = [c for c in ("defect",) if c in records.columns]
    rows = records.select(*scope, "record_pos", *marks, "record_json")
    parsed = pinned(rows, t=F.from_json("record_json", RECORD_TEXT))
    written = _written(F.col("t"))
    fielded = pinned(parsed, **risk_fields(F.col("t"), F.col("record_json")), **written).drop("record_json", "t")
    reason = F.when(F.col("defect").isNull(), _defect()) if marks else _defect()
    return fielded.withColumn("reject_reason", reason).drop(*written)


def _sound(judged: DataFrame) -> Column:
    sound = F.col("reject_reason").isNull()
    return sound & F.col("defect").isNull() if "defect" in judged.columns else sound


def accepted_risk_rows(judged: DataFrame, scope: list[str]) -> DataFrame:
    """Snapshot rows of judged records. `scope` names the payload and holds snapshot_key, run_id and snapshot_time."""
    kept = first_by(judged.filter(_sound(judged)), [*scope, "sentry_id"], ["record_pos"])
    return kept.select(*table_columns("fact_sentry_risk_snapshot"))


def payload_tally(judged: DataFrame, scope: list[str]) -> DataFrame:
    """Per payload: received, valid and skipped counts; of judged entries also the `defect` of silent ones."""
    marked = "defect" in judged.columns
    one = F.count_if(F.col("defect").isNull()) if marked else F.count(F.lit(1))
    ids = judged.groupBy(*scope, F.when(_sound(judged), F.col("sentry_id")).alias("kept")).agg(
        one.alias("n"), *([F.max("defect").alias("defect")] if marked else []))
    return ids.groupBy(*scope).agg(
        *([F.max("defect").alias("defect")] if marked else []), F.sum("n").alias("records_received"), F.count("kept").alias("valid_records"),
        (F.sum("n") - F.count("kept")).alias("skipped_records"))


def accepted_risk(records: DataFrame, scope: list[str]) -> DataFrame:
    """Snapshot rows of raw records."""
    return accepted_risk_rows(judge_risk(records, scope), scope)


def classified_risk(records: DataFrame, scope: list[str]) -> DataFrame:
    """Every record with its verdict, later copies marked `duplicate`: numbered in one pass, as copies lie in one payload."""
    judged = judge_risk(records, scope)
    copies = Window.partitionBy(*scope, "sentry_id", F.col("reject_reason").isNull()).orderBy("record_pos")
    numbered = judged.withColumn("copy", F.row_number().over(copies))
    later = F.col("reject_reason").isNull() & (F.col("copy") > 1)
    return numbered.withColumn("reject_reason", F.when(later, "duplicate").otherwise(F.col("reject_reason"))).drop("copy")


def risk_tally(records: DataFrame, scope: list[str]) -> DataFrame:
    """Per payload: received, valid and skipped counts of raw records or entries."""
    return payload_tally(judge_risk(records, scope), scope)
