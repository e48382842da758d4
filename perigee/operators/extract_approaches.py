"""Close-approach records to table rows: ordered rejection, optional fields, first copy wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.functions.dates import approach_datetime, iso_date
from perigee.functions.numbers import above, to_double
from perigee.operators.picking import first_by
from perigee.runtime import pinned
from perigee.schemas import table_columns

# A record is parsed once: leaves as text, and those whose JSON type matters under that type, where a
# value of another type reads as NULL.
RECORD = (
    "id string, name string, absolute_magnitude_h string, is_potentially_hazardous_asteroid boolean, is_sentry_object boolean, "
    "estimated_diameter struct<kilometers: struct<estimated_diameter_min: string, estimated_diameter_max: string>>, "
    "close_approach_data array<struct<close_approach_date: string, close_approach_date_full: string, epoch_date_close_approach: bigint, "
    "miss_distance: struct<kilometers: string>, relative_velocity: struct<kilometers_per_second: string>>>"
)
# Where a record came from; the smallest wins among copies.
PLACE = ["entry_pos", "record_pos"]


def _given(text: Column) -> Column:
    """Present and not the empty text."""
    return F.coalesce(text != "", F.lit(False))


def mandatory_fields(t: Column, near: Column) -> dict[str, Column]:
    """The table columns of one record by which it is judged; `near` is its first approach."""
    return {
        "id": t["id"],
        "name": t["name"],
        "closest_approach_date": iso_date(near["close_approach_date"]),
        "miss_distance_km": to_double(near["miss_distance"]["kilometers"]),
        "hazardous": t["is_potentially_hazardous_asteroid"],
    }


def approach_numbers(t: Column, near: Column) -> dict[str, Column]:
    """The optional numbers of one record, read once."""
    sizes = t["estimated_diameter"]["kilometers"]
    return {
        "low": to_double(sizes["estimated_diameter_min"]), "high": to_double(sizes["estimated_diameter_max"]),
        "speed": to_double(near["relative_velocity"]["kilometers_per_second"]),
    }


def optional_fields(t: Column, near: Column) -> dict[str, Column]:
    """The other table columns, given `approach_numbers`. Those that are malformed are NULL, never a rejection."""
    low, high = above(F.col("low"), 0.0), above(F.col("high"), 0.0)
    inverted = F.coalesce(low > high, F.lit(False))
    return {
        "close_approach_datetime": approach_datetime(near["close_approach_date_full"]),
        "close_approach_epoch_ms": near["epoch_date_close_approach"],
        "relative_velocity_km_s": above(F.col("speed"), 0.0),
        "absolute_magnitude_h": to_double(t["absolute_magnitude_h"]),
        "estimated_diameter_min_km": F.when(~inverted, low),
        "estimated_diameter_max_km": F.when(~inverted, high),
        "is_sentry_object": t["is_sentry_object"],
    }


def _presence(t: Column, near: Column) -> dict[str, Column]:
    """Which mandatory parts a record holds at all."""
    return {
        "has_id": _given(t["id"]), "has_name": _given(t["name"]), "has_approach": near.isNotNull(),
        "has_date": _given(near["close_approach_date"]), "has_distance": _given(near["miss_distance"]["kilometers"]),
    }


def _defect() -> Column:
    """The first mandatory field that fails, in the order they are judged; NULL for a sound record."""
    return (
        F.when(~F.col("has_id"), "missing_id")
        .when(~F.col("has_name"), "missing_name")
        .when(~F.col("has_approach"), "missing_approach")
        .when(~F.col("has_date"), "missing_date")
        .when(F.col("closest_approach_date").isNull(), "invalid_date")
        .when(~F.col("has_distance"), "missing_distance")
        .when(F.col("miss_distance_km").isNull(), "invalid_distance")
        .when(F.col("miss_distance_km") <= 0, "distance_not_positive")
        .when(F.col("hazardous").isNull(), "hazard_flag_not_boolean")
    )


def judge_approaches(records: DataFrame, scope: list[str]) -> DataFrame:
    """All records with their fields and `reject_reason`, before copies are compared.

    Given the entries of payloads, the row of a silent payload keeps its `defect` and has no reason.
    """
    marks = [c for c in ("defect",) if c in records.columns]
    # The first approach is taken out beside the parse: in each field it would swell the generated method over its limit.
    both = F.transform(F.array(F.from_json("record_json", RECORD)), lambda t: F.struct(t.alias("t"), F.get(t["close_approach_data"], 0).alias("near")))
    parsed = records.select(*scope, *PLACE, *marks, F.inline(both))
    t, near = F.col("t"), F.col("near")
    fields, parts = mandatory_fields(t, near), _presence(t, near)
    fielded = pinned(parsed, **fields, **parts)
    reason = F.when(F.col("defect").isNull(), _defect()) if marks else _defect()
    # Optional fields decide nothing, so they are plain columns: readers of the verdict alone don't compute them.
    return fielded.withColumns(approach_numbers(t, near)).select(
        *scope, *PLACE, *marks, *fields, *[v.alias(k) for k, v in optional_fields(t, near).items()], reason.alias("reject_reason"))


def _sound(judged: DataFrame) -> Column:
    sound = F.col("reject_reason").isNull()
    return sound & F.col("defect").isNull() if "defect" in judged.columns else sound


def accepted_rows(judged: DataFrame, scope: list[str], placed: bool = False) -> DataFrame:
    """The table rows of judged records: the first sound one of each (id, date) within its payload
    (`scope`), with their place in it if `placed`."""
    kept = first_by(judged.filter(_sound(judged)), [*scope, "id", "closest_approach_date"], PLACE)
    return kept.select(*scope, *(PLACE if placed else []), *table_columns("asteroids"))


def payload_tally(judged: DataFrame, scope: list[str]) -> DataFrame:
    """Per payload: received, valid and skipped counts; of judged entries also the `defect` of silent ones.

    Copies are counted by grouping, not by comparing rows: valid is the number of distinct sound
    (id, date) pairs.
    """
    marked = "defect" in judged.columns
    pair = F.when(_sound(judged), F.struct("id", "closest_approach_date"))
    one = F.count_if(F.col("defect").isNull()) if marked else F.count(F.lit(1))
    pairs = judged.groupBy(*scope, pair.alias("pair")).agg(one.alias("n"), *([F.max("defect").alias("defect")] if marked else []))
    return pairs.groupBy(*scope).agg(
        *([F.max("defect").alias("defect")] if marked else []), F.sum("n").alias("records_received"), F.count("pair").alias("valid_records"),
        (F.sum("n") - F.count("pair")).alias("skipped_records"))


def settled_payloads(judged: DataFrame, scope: list[str]) -> DataFrame:
    """Judged entries of payloads, one row per sound (id, date) of a payload and one for its other records together.

    `kept` holds the table row, NULL for the other records; every row has the tally of its payload, and `nth` numbers
    the rows of a payload. Payloads are dealt out once: whatever is compared or counted lies in one of them, which is
    no larger than a document that one task has parsed before.
    """
    sound = _sound(judged)
    pair = F.when(sound, F.struct("id", "closest_approach_date"))
    row = F.when(sound, F.struct(*PLACE, F.struct(*table_columns("asteroids")).alias("kept")))
    found = judged.repartition(*scope).groupBy(*scope, pair.alias("pair")).agg(
        F.count_if(F.col("defect").isNull()).alias("n"), F.max("defect").alias("said"), F.min(row).alias("row"))
    payload = Window.partitionBy(*scope)
    tallied = found.select(
        *scope, F.col("row.kept").alias("kept"), F.row_number().over(payload.orderBy("pair")).alias("nth"), F.max("said").over(payload).alias("defect"),
        F.sum("n").over(payload).alias("records_received"), F.count("pair").over(payload).alias("valid_records"))
    return tallied.withColumn("skipped_records", F.col("records_received") - F.col("valid_records"))


def accepted_approaches(records: DataFrame, scope: list[str], placed: bool = False) -> DataFrame:
    """The table rows of raw records."""
    return accepted_rows(judge_approaches(records, scope), scope, placed)


def classified_approaches(records: DataFrame, scope: list[str]) -> DataFrame:
    """Every record with its verdict, later copies marked `duplicate`.

    Copies are numbered beside each other in one pass; they lie in one payload, so a group is no larger than
    a document that one task has parsed before.
    """
    judged = judge_approaches(records, scope)
    copies = Window.partitionBy(*scope, "id", "closest_approach_date", F.col("reject_reason").isNull()).orderBy(*PLACE)
    numbered = judged.withColumn("copy", F.row_number().over(copies))
    later = F.col("reject_reason").isNull() & (F.col("copy") > 1)
    return numbered.withColumn("reject_reason", F.when(later, "duplicate").otherwise(F.col("reject_reason"))).drop("copy")


def approach_tally(records: DataFrame, scope: list[str]) -> DataFrame:
    """Per payload: received, valid and skipped counts of raw records or entries."""
    return payload_tally(judge_approaches(records, scope), scope)
