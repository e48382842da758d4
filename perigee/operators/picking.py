"""Keep one row per key.

A pick is an aggregate (`max`/`min` of an ordering struct that carries the row), so each task
reduces a hot key to one row before the shuffle; no task ever sees a whole group. All columns must
be orderable, so no maps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.runtime import materialize


def _pick(df: DataFrame, keys: list[str], order: list[str], largest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    # The whole row is one struct that starts with the ordering; the other columns break ties, so
    # equal orderings still give one fixed row. NULL must sort last when the struct is minimised.
    ordering = [F.col(c) for c in order] if largest else [
        part for c in order for part in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    row = F.struct(*ordering, *rest)
    picked = df.groupBy(*keys).agg((F.max if largest else F.min)(row).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest `order` per key; NULL is smallest."""
    return _pick(df, keys, order, largest=True)


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest `order` per key; NULL is largest."""
    return _pick(df, keys, order, largest=False)


def closest_encounter(approaches: DataFrame, key: str = "id") -> DataFrame:
    """One approach per object: smallest distance, then earliest date."""
    return first_by(approaches, [key], ["miss_distance_km", "closest_approach_date"])


def newest_partition(approaches: DataFrame) -> DataFrame:
    """One row per (id, date): the one from the newest date partition."""
    return latest_by(approaches, ["id", "closest_approach_date"], ["year", "month", "day"])


def most_severe(df: DataFrame, keys: list[str], state: str, severity: dict[str, int]) -> DataFrame:
    """One row per key: the most conservative state."""
    weight = F.coalesce(F.create_map(*[F.lit(x) for kv in severity.items() for x in kv])[F.col(state)], F.lit(0))
    return latest_by(df.withColumn("__severity", weight), keys, ["__severity"]).drop("__severity")


def preferred_pivot(bridge: DataFrame, system: str, name: str) -> DataFrame:
    """One identifier per entity: the primary pivot first, then the smallest value."""
    rows = bridge.filter((F.col("source_system") == system) & (F.col("identifier_name") == name))
    ranked = rows.select(
        "asteroid_key",
        F.when(F.col("is_primary_pivot"), 0).when(F.col("is_primary_pivot").isNull(), 2).otherwise(1).alias("rank"),
        F.col("identifier_value").alias("spkid"),
    )
    return first_by(ranked, ["asteroid_key"], ["rank", "spkid"]).drop("rank")


def distinct_identifiers(bridge: DataFrame, system: str, name: str) -> DataFrame:
    """Distinct non-empty identifier values per entity."""
    wanted = (F.col("source_system") == system) & (F.col("identifier_name") == name)
    return bridge.filter(wanted & (F.col("identifier_value") != "")).select("asteroid_key", "identifier_value").distinct()


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None, between: str | None = None,
) -> DataFrame:
    """The incoming rows, one per key, whose key is not in the target.

    Of several incoming copies the first by `order` stays, then the smallest by the other columns; the
    order columns are left out of the result unless the target has them. With `between`, one of the
    keys, only the target's rows in the incoming range of that column are read.
    """
    order = order or []
    # Written, so that what comes in is computed once for its range and for the join.
    fresh = materialize(first_by(incoming, keys, order), "incoming")
    if between:
        low, high = fresh.agg(F.min(between), F.max(between)).first()
        target = target.filter(F.col(between).between(F.lit(low), F.lit(high)))
    kept = fresh.drop(*[c for c in order if c not in target.columns])
    return kept.join(target.select(*keys), keys, "left_anti")
