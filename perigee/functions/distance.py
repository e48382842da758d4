"""Distance scales: a piecewise height scale, the reveal journey, and million-km bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scale, in km, and the two joins of the journey.
SURFACE_KM = 6371.0
MOON_KM = 384_400.0
FIELD_KM = 1_000_000.0
STEP_KM = 1_000_000.0
DOMAIN_FLOOR_KM = 1e8
MOON_PROGRESS = 0.16
FIELD_PROGRESS = 0.22


def height(km: Column, moon_height: float, field_height: float, million_height: float) -> Column:
    """Strictly increasing height: logarithmic to the Moon, linear to 1 M km, linear per million beyond.

    Distances that are not positive have no height.
    """
    sky = F.lit(moon_height) * F.log1p(km / SURFACE_KM) / F.log1p(F.lit(MOON_KM / SURFACE_KM))
    past_moon = F.lit(moon_height) + F.lit(field_height - moon_height) * (km - MOON_KM) / F.lit(FIELD_KM - MOON_KM)
    field = F.lit(field_height) + F.lit(million_height) * (km - FIELD_KM) / F.lit(STEP_KM)
    return F.when(km <= 0, None).when(km <= MOON_KM, sky).when(km <= FIELD_KM, past_moon).otherwise(field)


def domain_maximum(farthest_km: Column) -> Column:
    """Upper end of the scale: 5 % beyond the farthest value, in whole ten millions, at least 1e8."""
    padded = F.ceil(F.coalesce(farthest_km, F.lit(0.0)) * 1.05 / 1e7) * F.lit(1e7)
    return F.greatest(F.lit(DOMAIN_FLOOR_KM), padded.cast("double"))


def revealed_km(progress: Column, maximum: Column) -> Column:
    """Distance reached at a progress in [0, 1]: two logarithmic stages, then linear to the maximum."""
    p = F.least(F.greatest(progress, F.lit(0.0)), F.lit(1.0))
    first = F.lit(SURFACE_KM) * F.pow(F.lit(MOON_KM / SURFACE_KM), p / MOON_PROGRESS)
    second = F.lit(MOON_KM) * F.pow(F.lit(FIELD_KM / MOON_KM), (p - MOON_PROGRESS) / (FIELD_PROGRESS - MOON_PROGRESS))
    third = F.least(maximum, F.lit(FIELD_KM) + (maximum - FIELD_KM) * ((p - FIELD_PROGRESS) / (1 - FIELD_PROGRESS)))
    return F.when(p == 0, 0.0).when(p <= MOON_PROGRESS, first).when(p <= FIELD_PROGRESS, second).otherwise(third)


def progress_at(km: Column, maximum: Column) -> Column:
    """The progress at which a distance is first reached."""
    first = F.lit(MOON_PROGRESS) * F.log(km / SURFACE_KM) / F.log(F.lit(MOON_KM / SURFACE_KM))
    second = F.lit(MOON_PROGRESS) + F.lit(FIELD_PROGRESS - MOON_PROGRESS) * F.log(km / MOON_KM) / F.log(
        F.lit(FIELD_KM / MOON_KM))
    third = F.lit(FIELD_PROGRESS) + (F.least(km, maximum) - FIELD_KM) / (maximum - FIELD_KM) * (1 - FIELD_PROGRESS)
    return (
        F.when(km.isNull() | (km <= SURFACE_KM) | F.isnan(km), 0.0)
        .when(km <= MOON_KM, first).when(km <= FIELD_KM, second).otherwise(third)
    )


def band(km: Column) -> Column:
    """Whole millions of km below a distance."""
    return F.floor(km / STEP_KM).cast("bigint")


def band_tier(millions: Column) -> Column:
    return (
        F.when(F.pmod(millions, F.lit(10)) == 0, "major").when(F.pmod(millions, F.lit(5)) == 0, "mid").otherwise("minor")
    )


def frontier_label(km: Column) -> Column:
    """Whole millions from 1 M km, else whole ten thousands."""
    return F.when(km >= STEP_KM, F.floor(km / STEP_KM) * STEP_KM).otherwise(F.floor(km / 10_000) * 10_000.0)
