"""Dates and times kept as text in the tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.functions.text import strip


def iso_date(text: Column) -> Column:
    """The text itself when it is a real yyyy-MM-dd calendar date, else NULL."""
    return F.regexp_extract(strip(text), r"^([0-9]{4}-[0-9]{2}-[0-9]{2})$", 1).try_cast("date").cast("string")


def approach_datetime(text: Column) -> Column:
    """`2026-Sep-29 07:18` to `2026-09-29T07:18`; no zone is added."""
    stamp = F.try_to_timestamp(strip(text), F.lit("yyyy-MMM-d H:m"))
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm")


def days_between(earlier: Column, later: Column) -> Column:
    """Whole days from one date text to another; NULL if either is NULL."""
    return F.datediff(later.cast("date"), earlier.cast("date")).cast("bigint")


def hours_between(earlier: Column, later: Column) -> Column:
    """Complete hours between two timestamps."""
    return F.timestamp_diff("HOUR", earlier, later)


def date_of(moment: Column) -> Column:
    """Calendar date of a date, a timestamp, or ISO text (the part before `T`)."""
    return F.split(moment.cast("string"), "[T ]")[0].cast("date")


def date_parts(moment: Column) -> dict[str, Column]:
    """Zero-padded partition texts."""
    day = date_of(moment)
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }


def run_document_path(moment: Column, run_id: Column) -> Column:
    """Where a run's manifest is published."""
    parts = date_parts(moment)
    return F.concat(
        F.lit("metadata/pipeline_runs/year="), parts["year"], F.lit("/month="), parts["month"],
        F.lit("/day="), parts["day"], F.lit("/run_manifest_"), strip(run_id), F.lit(".json"),
    )
