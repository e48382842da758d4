"""Availability blocks: which values of a section are missing, and why."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee import vocabulary as V


def unavailable_fields(values: dict[str, Column], reason: Column, older: Column | None = None) -> Column:
    """map(field -> reason) of the NULL values; fields listed in the array `older` predate the dataset."""
    why = F.coalesce(reason, F.lit(V.NOT_IN_SOURCE))
    entries = []
    for name, value in values.items():
        cause = why if older is None else F.when(F.array_contains(older, name), V.NOT_IN_CONTRACT).otherwise(why)
        entries.append(F.when(value.isNull(), F.struct(F.lit(name).alias("key"), cause.alias("value"))))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


def section(values: dict[str, Column], reason: Column, older: Column | None = None) -> Column:
    """Struct (status, unavailable)."""
    # The status is told from the values: the map, which costs most, is built once and not for its size too.
    lost = sum((value.isNull().cast("int") for value in values.values()), F.lit(0))
    status = F.when(lost == 0, V.AVAILABLE).when(lost == len(values), V.UNAVAILABLE).otherwise(V.PARTIAL)
    return F.struct(status.alias("status"), unavailable_fields(values, reason, older).alias("unavailable"))


def override_reason(block: Column, fields: list[str], reason: str, when: Column) -> Column:
    """Replace (or add) the reason of some fields of an availability block."""
    patch = F.create_map(*[part for name in fields for part in (F.lit(name), F.lit(reason))])
    kept = F.map_filter(block["unavailable"], lambda k, _: ~k.isin(fields))
    changed = block.withField("unavailable", F.map_concat(kept, patch))
    return F.when(when, changed).otherwise(block)


def catalog_status(match_state: Column, spkid: Column, snapshot_key: Column) -> Column:
    return (
        F.when(match_state != V.RESOLVED, V.NOT_RESOLVED)
        .when(spkid.isNull() | snapshot_key.isNull(), V.NOT_PRESENT)
        .otherwise(V.AVAILABLE)
    )


def risk_status(match_state: Column, links: Column, snapshot_key: Column) -> Column:
    return (
        F.when(match_state != V.RESOLVED, V.NOT_RESOLVED)
        .when(links == 0, V.NOT_PRESENT)
        .when(links > 1, V.LINK_AMBIGUOUS)
        .when(snapshot_key.isNull(), V.LINKED_NO_RECORD)
        .otherwise(V.AVAILABLE)
    )


def risk_gap_reason(status: Column) -> Column:
    """Why an assessment has no values, by linkage status; NULL when it is available."""
    return (
        F.when(status == V.NOT_RESOLVED, V.NOT_RESOLVED)
        .when(status == V.LINK_AMBIGUOUS, V.AMBIGUOUS_LINKAGE)
        .when(status.isin(V.NOT_PRESENT, V.LINKED_NO_RECORD), V.NOT_IN_SOURCE)
    )


def dominant_reason(missing: Column) -> Column:
    """The most frequent reason of an availability map; the earliest listed wins a tie."""
    reasons = F.map_values(missing)
    distinct = F.array_distinct(reasons)
    scored = F.transform(
        distinct,
        lambda r: F.struct(
            F.size(F.filter(reasons, lambda x: x == r)).alias("n"),
            (-F.array_position(reasons, r)).alias("earliness"),
            r.alias("reason"),
        ),
    )
    return F.array_max(scored)["reason"]
