"""Orbit and observation-quality scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.vocabulary import LIMITED_ARC, LUNAR_DISTANCE_KM, UNREPORTED, WELL_CONSTRAINED


def lunar_distances(km: Column) -> Column:
    return km / F.lit(LUNAR_DISTANCE_KM)


def period_from_axis(semi_major_axis_au: Column) -> Column:
    """Kepler's third law in years, for a positive axis."""
    return F.when(semi_major_axis_au > 0, F.pow(semi_major_axis_au, F.lit(1.5)))


def period_from_days(days: Column) -> Column:
    """The published period in Julian years."""
    return days / F.lit(365.25)


def quality_tier(arc_days: Column, observations: Column, condition_code: Column) -> Column:
    """UNREPORTED with nothing known; well constrained with code < 5, arc >= 30 days and >= 20 observations."""
    nothing = arc_days.isNull() & observations.isNull() & condition_code.isNull()
    good = (condition_code.try_cast("int") < 5) & (arc_days >= 30) & (observations >= 20)
    return F.when(nothing, F.lit(UNREPORTED)).when(good, F.lit(WELL_CONSTRAINED)).otherwise(F.lit(LIMITED_ARC))
