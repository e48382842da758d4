"""The ad-hoc questions about the approach table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _near() -> list[Column]:
    """Closest first; ties are broken, so a top-k is one fixed set."""
    return [F.asc_nulls_last("miss_distance_km"), F.asc("id"), F.asc("closest_approach_date")]


def in_partition(approaches: DataFrame, year: str, month: str | None = None, day: str | None = None,
                 last_day: str | None = None) -> DataFrame:
    """Rows of some date partitions; the conditions prune directories."""
    rows = approaches.filter(F.col("year") == year)
    if month is not None:
        rows = rows.filter(F.col("month") == month)
    if last_day is not None:
        return rows.filter(F.col("day").between(day, last_day))
    return rows if day is None else rows.filter(F.col("day") == day)


def daily_listing(approaches: DataFrame, year: str, month: str, day: str) -> DataFrame:
    return in_partition(approaches, year, month, day).select(
        "id", "name", "closest_approach_date", "miss_distance_km", "hazardous").orderBy(*_near())


def monthly_summary(approaches: DataFrame, year: str, month: str) -> DataFrame:
    km = "miss_distance_km"
    return in_partition(approaches, year, month).groupBy("hazardous").agg(
        F.count(F.lit(1)).alias("asteroid_count"), F.round(F.min(km), 2).alias("min_miss_distance_km"),
        F.round(F.avg(km), 2).alias("avg_miss_distance_km"), F.round(F.max(km), 2).alias("max_miss_distance_km"))


def hazardous_in_range(approaches: DataFrame, year: str, month: str, first: str, last: str, k: int = 10) -> DataFrame:
    rows = in_partition(approaches, year, month, first, last).filter(F.col("hazardous"))
    return rows.select("id", "name", "closest_approach_date", "miss_distance_km").orderBy(*_near()).limit(k)


def totals(approaches: DataFrame) -> DataFrame:
    """Total, hazardous and average distance in one pass."""
    return approaches.agg(
        F.count(F.lit(1)).alias("total_asteroids"), F.count_if("hazardous").alias("hazardous_asteroids"),
        F.avg("miss_distance_km").alias("average_miss_distance_km"))


def by_hazard(approaches: DataFrame) -> DataFrame:
    return approaches.groupBy("hazardous").agg(F.count(F.lit(1)).alias("asteroid_count"))


def by_date(approaches: DataFrame) -> DataFrame:
    return approaches.groupBy("closest_approach_date").agg(F.count(F.lit(1)).alias("asteroid_count")).orderBy(
        "closest_approach_date")


def closest(approaches: DataFrame, k: int = 10, hazardous_only: bool = False) -> DataFrame:
    rows = approaches.filter(F.col("hazardous")) if hazardous_only else approaches
    return rows.orderBy(*_near()).limit(k).select("id", "name", "closest_approach_date", "miss_distance_km", "hazardous")


def farthest(approaches: DataFrame, k: int = 10) -> DataFrame:
    return approaches.orderBy(F.desc_nulls_last("miss_distance_km"), "id", "closest_approach_date").limit(k).select("id", "name", "closest_approach_date", "miss_distance_km", "hazardous")


def hazardous_beyond(approaches: DataFrame, km: float = 10_000_000.0) -> DataFrame:
    rows = approaches.filter(F.col("hazardous") & (F.col("miss_distance_km") > km))
    return rows.select("id", "name", "miss_distance_km").orderBy(*_near()[:2])
