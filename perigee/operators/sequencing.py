"""Previous and next rows of a key, and the snapshot timeline.

A plain window would put one key's whole history into one task. Here the history is cut into
calendar buckets: a window runs inside each (key, bucket), and only the first and last row of each
bucket, aggregated map-side, travel to the window over the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.functions.dates import iso_date
from perigee.runtime import materialize


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    carry: list[str],
    bucket: Column | None = None,
    want_next: bool = False,
) -> DataFrame:
    """Add struct columns `prev` (and `next`) holding `carry` of the neighbouring row.

    `bucket` must not decrease along `order`. Keys are never NULL in the tables this reads.
    """
    value = F.struct(*carry)
    if bucket is None:
        run = Window.partitionBy(*keys).orderBy(*order)
        out = df.withColumn("prev", F.lag(value).over(run))
        return out.withColumn("next", F.lead(value).over(run)) if want_next else out

    cut = df.withColumn("__bucket", bucket)
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    # Stated, because a window over (key, bucket) would also accept rows that an earlier join left
    # partitioned by key alone, and a hot key would stay whole.
    body = cut.repartition(*keys, "__bucket").withColumn("__before", F.lag(value).over(inside)).withColumn("__after", F.lead(value).over(inside))

    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    edges = cut.groupBy(*keys, "__bucket").agg(
        F.min_by(value, rank).alias("__first"), F.max_by(value, rank).alias("__last"))
    across = Window.partitionBy(*keys).orderBy("__bucket")
    edges = edges.select(
        *keys, "__bucket",
        F.lag("__last").over(across).alias("__carried_before"),
        F.lead("__first").over(across).alias("__carried_after"),
    )
    joined = body.join(edges, [*keys, "__bucket"], "left")
    kept = [F.col(c) for c in df.columns]
    prev = F.coalesce("__before", "__carried_before").alias("prev")
    following = F.coalesce("__after", "__carried_after").alias("next")
    return joined.select(*kept, prev, following) if want_next else joined.select(*kept, prev)


def month_of(key: str) -> Column:
    """Bucket of a yyyy-MM-dd key: at most 31 days, so buckets stay small and few."""
    return F.substring(F.col(key), 1, 7)


# Lengths of the parts of a yyyy-MM-dd key that count years and months.
CALENDAR = (4, 7)


def in_sequence(keys: DataFrame, key: str, parts: tuple[int, ...] = CALENDAR) -> DataFrame:
    """Distinct keys with `seq`, their rank from 1, and `next_key`, the key that follows.

    A prefix sum over the calendar: keys are numbered inside their month, months inside their year and
    years on their own; what lies before and the first key behind are handed down. So a window holds at
    most 31 days, 12 months or one row per year. Any text is put in its right place, as text order is
    kept by prefixes; only keys that aren't dates (`not_dates` finds them) can make windows larger.
    """
    levels = []  # from years to months: one row per prefix, with its keys and the first of them
    for length in parts:
        prefix = F.substring(F.col(key), 1, length)
        levels.append(keys.groupBy(prefix.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")))
    above = None
    for level, length in zip(levels, (0, *parts)):
        order = (Window.partitionBy("outer") if length else Window).orderBy("part")
        rows = level.withColumn("outer", F.substring("part", 1, length)) if length else level
        rows = rows.withColumns({
            "before": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "behind": F.lead("first").over(order)})
        if above is not None:
            rows = rows.join(above, "outer").select(
                "part", (F.col("before") + F.col("outer_before")).alias("before"), F.coalesce("behind", "outer_behind").alias("behind"))
        above = rows.select(F.col("part").alias("outer"), F.col("before").alias("outer_before"), F.col("behind").alias("outer_behind"))
    order = Window.partitionBy("outer").orderBy(key)
    placed = keys.withColumn("outer", F.substring(F.col(key), 1, parts[-1])).withColumns({
        "inside": F.row_number().over(order), "behind": F.lead(key).over(order)})
    return placed.join(above, "outer").select(
        *keys.columns, (F.col("outer_before") + F.col("inside")).cast("bigint").alias("seq"), F.coalesce("behind", "outer_behind").alias("next_key"))


def not_dates(keys: DataFrame, key: str) -> DataFrame:
    """Keys that aren't calendar dates written yyyy-MM-dd."""
    return keys.filter(F.col(key).isNotNull() & ~F.col(key).eqNullSafe(iso_date(F.col(key))))


def timeline(snapshots: DataFrame) -> DataFrame:
    """Coverage: one row per snapshot day with counts, times, a dense sequence and the next captured day.

    The days are written first, so the snapshots are read once for all levels of the sequence.
    """
    days = snapshots.filter(F.col("snapshot_key").isNotNull()).groupBy("snapshot_key").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("snapshot_time").alias("first_snapshot_time"),
        F.max("snapshot_time").alias("last_snapshot_time"),
    )
    return in_sequence(materialize(days, "snapshot-days"), "snapshot_key").select(
        "snapshot_key",
        F.lit(True).alias("is_captured"),
        "row_count", "first_snapshot_time", "last_snapshot_time",
        F.col("seq").alias("snapshot_seq"), "next_key",
    )
