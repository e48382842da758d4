"""Distances of the whole population: domain, reveal order and steps, bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions import distance as D
from perigee.runtime import one_row


def distance_domain(rows: DataFrame, km: str = "miss_distance_km") -> DataFrame:
    """The one-row scale of a population."""
    return rows.agg(F.max(km).alias("farthest")).select(
        F.lit(D.SURFACE_KM).alias("min_km"), D.domain_maximum(F.col("farthest")).alias("max_km"))


def reveal_order(rows: DataFrame, km: str = "miss_distance_km", ident: str = "neows_id") -> DataFrame:
    """Closest first, ties by id; a range-partitioned sort, no single-task ranking."""
    return rows.select(ident, km).orderBy(F.asc_nulls_last(km), ident)


def reveal_counts(rows: DataFrame, steps: list[float], km: str = "miss_distance_km") -> DataFrame:
    """For each progress step: the distance reached and how many rows it reveals.

    One aggregate with one conditional count per step; nothing is paired.
    """
    with_domain = rows.select(km).crossJoin(one_row(distance_domain(rows, km)))
    reached = [D.revealed_km(F.lit(float(p)), F.col("max_km")) for p in steps]
    counted = with_domain.agg(F.max("max_km").alias("max_km"), *[
        F.count_if(F.col(km) <= r).alias(f"n{i}") for i, r in enumerate(reached)])
    listed = F.array(*[
        F.struct(F.lit(float(p)).alias("progress"), r.alias("frontier_km"), F.col(f"n{i}").alias("revealed"))
        for i, (p, r) in enumerate(zip(steps, reached))])
    return counted.select(F.explode(listed).alias("s")).select("s.*")


def band_counts(rows: DataFrame, km: str = "miss_distance_km") -> DataFrame:
    """Rows per million-km band, every band of the domain listed, with its tier."""
    counted = rows.groupBy(D.band(F.col(km)).alias("band")).agg(F.count(F.lit(1)).alias("n"))
    bands = distance_domain(rows, km).select(
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.floor(F.col("max_km") / D.STEP_KM))).alias("band"))
    joined = bands.join(counted, "band", "left")
    return joined.select(
        "band", D.band_tier(F.col("band")).alias("tier"), F.coalesce("n", F.lit(0)).cast("bigint").alias("objects"))


def bands_between(domain: DataFrame, low_km: float, high_km: float) -> DataFrame:
    """The bands of a domain inside a distance window."""
    first = max(1, -int(-low_km // D.STEP_KM))
    top = F.least(F.floor(F.col("max_km") / D.STEP_KM), F.lit(int(high_km // D.STEP_KM)).cast("bigint"))
    span = F.when(top >= first, F.sequence(F.lit(first).cast("bigint"), top))
    return domain.select(F.explode(span).alias("band")).withColumn("tier", D.band_tier(F.col("band")))
