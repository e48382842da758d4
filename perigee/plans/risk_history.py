"""Longitudinal risk datasets: coverage, metric history, presence, lifecycle, one-object history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.functions.change import any_differs, coverage_gap, flag, presence_state
from perigee.functions.dates import days_between, hours_between
from perigee.operators.picking import latest_by
from perigee.operators.sequencing import month_of, timeline, with_neighbours
from perigee.operators.tallying import keys_per_identifier
from perigee.runtime import materialize, one_row
from perigee.vocabulary import EXIT, RISK_FEED

METRICS = [
    "impact_probability", "palermo_scale_cum", "palermo_scale_max", "torino_scale_max",
    "potential_impacts_count", "v_infinity_km_s", "last_obs_date", "estimated_diameter_km", "absolute_magnitude",
]
DELTAS = [
    "impact_probability", "palermo_scale_max", "palermo_scale_cum", "torino_scale_max",
    "potential_impacts_count", "v_infinity_km_s",
]
# Order of an object's rows; the tail only decides between rows of one snapshot day.
ROW_ORDER = ["snapshot_key", "snapshot_time", "run_id"]


def snapshot_coverage(risk: DataFrame) -> DataFrame:
    """One row per captured snapshot day."""
    return timeline(risk).drop("next_key")


def _on_timeline(risk: DataFrame, coverage: DataFrame) -> DataFrame:
    """Rows with their snapshot sequence. The coverage is written out first, so Catalyst knows its
    size and broadcasts it only while it is small."""
    return risk.join(coverage, "snapshot_key", "inner")


def risk_metric_history(risk: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per snapshot row: the metrics, their previous values, linear deltas and change flags.

    An object whose identifier maps to several entities appears once per entity.
    """
    days = materialize(timeline(risk).select("snapshot_key", F.col("snapshot_seq").alias("seq")), "coverage")
    linked = (
        bridge.filter((F.col("source_system") == RISK_FEED) & (F.col("identifier_name") == "sentry_id"))
        .select(F.col("identifier_value").alias("sentry_id"), "asteroid_key").distinct()
    )
    rows = _on_timeline(risk, days).join(linked, "sentry_id", "left")
    seen = with_neighbours(
        rows, ["sentry_id"], [*ROW_ORDER, "asteroid_key"], ["seq", "snapshot_key", *METRICS], bucket=month_of("snapshot_key"))
    prev = F.col("prev")
    span = days_between(prev["snapshot_key"], F.col("snapshot_key"))
    changed = any_differs([
        (F.col(m), prev[m])
        for m in ("impact_probability", "palermo_scale_max", "torino_scale_max", "potential_impacts_count")
    ])
    first = prev["snapshot_key"].isNull()
    return seen.select(
        "snapshot_key", "snapshot_time", "sentry_id", "designation", "fullname", "asteroid_key",
        *METRICS,
        prev["snapshot_key"].alias("prev_snapshot_key"),
        *[prev[m].alias(f"prev_{m}") for m in METRICS],
        *[(F.col(m) - prev[m]).alias(f"delta_{m}") for m in DELTAS],
        days_between(prev["last_obs_date"], F.col("last_obs_date")).alias("delta_last_obs_days"),
        first.alias("is_first_snapshot"),
        flag(F.col("last_obs_date") > prev["last_obs_date"]).alias("has_new_observations"),
        (~first & changed).alias("is_metric_changed"),
        coverage_gap(prev["snapshot_key"], F.col("seq") - prev["seq"], span).alias("coverage_gap_flag"),
    )


def presence_history(risk: DataFrame) -> DataFrame:
    """Per snapshot row: neighbours of the object in the sequence, gap flag and presence state."""
    days = timeline(risk).select(
        "snapshot_key", F.col("snapshot_seq").alias("seq_curr"), F.col("next_key").alias("global_next_snapshot_key"))
    days = materialize(days, "coverage")
    rows = _on_timeline(
        risk.select("snapshot_key", "snapshot_time", "run_id", "sentry_id", "designation", "fullname"), days)
    seen = with_neighbours(
        rows, ["sentry_id"], ROW_ORDER, ["seq_curr", "snapshot_key"], bucket=month_of("snapshot_key"), want_next=True)
    prev, following = F.col("prev"), F.col("next")
    steps = F.col("seq_curr") - prev["seq_curr"]
    span = days_between(prev["snapshot_key"], F.col("snapshot_key"))
    ahead = days_between(F.col("snapshot_key"), F.col("global_next_snapshot_key"))
    state = presence_state(
        prev["snapshot_key"], steps, span, following["seq_curr"] - F.col("seq_curr"),
        F.col("global_next_snapshot_key"), ahead)
    out = seen.select(
        "snapshot_key", "snapshot_time", "sentry_id", "designation", "fullname", "seq_curr",
        prev["seq_curr"].alias("seq_prev"), prev["snapshot_key"].alias("prev_snapshot_key"),
        following["seq_curr"].alias("seq_next"), following["snapshot_key"].alias("next_snapshot_key"),
        "global_next_snapshot_key", ahead.alias("global_next_days_diff"), span.alias("days_since_prev"),
        coverage_gap(prev["snapshot_key"], steps, span).alias("coverage_gap_flag"),
        state.alias("presence_state"),
    )
    return out.withColumn("is_exit_after_this_snapshot", flag(F.col("presence_state") == EXIT))


def lifecycle_with_range(risk: DataFrame, bridge: DataFrame, as_of) -> DataFrame:
    """The lifecycle plus the impact year range of each object's last row.

    Two aggregates, per day and per object: first and last values come from ordering structs, so the
    history windows are not needed here.
    """
    rows = risk.filter(F.col("snapshot_key").isNotNull())
    at = F.struct(*ROW_ORDER)
    mandatory = ["impact_probability", "palermo_scale_max", "palermo_scale_cum", "torino_scale_max",
                 "potential_impacts_count", "v_infinity_km_s", "last_obs_date"]
    optional = ["estimated_diameter_km", "absolute_magnitude"]
    edge = ["snapshot_time", "designation", "fullname", "impact_year_range", *mandatory]
    # Days first: distinct days become a plain count, and a busy object arrives as one row per day.
    # An ordering that is NULL is ignored, which gives the first and last reported optional value.
    per_day = rows.groupBy("sentry_id", "snapshot_key").agg(
        F.min_by(F.struct(*edge), at).alias("first_row"),
        F.max_by(F.struct(*edge), at).alias("last_row"),
        *[F.max(m).alias(f"max_{m}") for m in mandatory[:5]],
        *[F.min_by(m, F.when(F.col(m).isNotNull(), at)).alias(f"first_{m}") for m in optional],
        *[F.max_by(m, F.when(F.col(m).isNotNull(), at)).alias(f"last_{m}") for m in optional],
    )
    day = F.col("snapshot_key")
    firsts = lambda c: F.min_by(F.col("first_row")[c], day)
    lasts = lambda c: F.max_by(F.col("last_row")[c], day)
    pairs = [x for m in mandatory for x in (firsts(m).alias(f"initial_{m}"), lasts(m).alias(f"latest_{m}"))]
    for m in optional:
        pairs += [
            F.min_by(f"first_{m}", F.when(F.col(f"first_{m}").isNotNull(), day)).alias(f"initial_{m}"),
            F.max_by(f"last_{m}", F.when(F.col(f"last_{m}").isNotNull(), day)).alias(f"latest_{m}"),
        ]
    maxima = [F.max(f"max_{m}").alias(f"all_time_max_{m}") for m in mandatory[:5]]
    lives = per_day.groupBy("sentry_id").agg(
        lasts("designation").alias("designation"), lasts("fullname").alias("fullname"),
        F.min(day).alias("first_snapshot_key"), firsts("snapshot_time").alias("first_snapshot_time"),
        F.max(day).alias("last_snapshot_key"), lasts("snapshot_time").alias("last_snapshot_time"),
        F.count(F.lit(1)).alias("total_snapshots_observed"),
        lasts("impact_year_range").alias("latest_impact_year_range"),
        *pairs, *maxima,
    )
    keys = keys_per_identifier(bridge, RISK_FEED, "sentry_id", "linked_id")
    lives = lives.join(keys, F.col("sentry_id") == F.col("linked_id"), "left")
    newest = one_row(rows.agg(F.max(F.struct("snapshot_key", "snapshot_time")).alias("newest")))
    stale = hours_between(F.col("newest.snapshot_time").cast("timestamp"), F.lit(as_of).cast("timestamp")) > 48
    active = F.when(~flag(stale), F.col("last_snapshot_key") == F.col("newest.snapshot_key"))
    count = F.coalesce("key_count", F.lit(0))
    return lives.crossJoin(newest).select(
        "sentry_id", "designation", "fullname",
        F.when(count == 1, F.col("first_key")).alias("asteroid_key"),
        (count > 1).alias("is_crosswalk_ambiguous"),
        "first_snapshot_key", "first_snapshot_time", "last_snapshot_key", "last_snapshot_time",
        "total_snapshots_observed",
        (days_between(F.col("first_snapshot_key"), F.col("last_snapshot_key")) + 1).alias("archive_observation_span_days"),
        active.alias("is_currently_active"),
        *[f"{p}_{m}" for m in mandatory for p in ("initial", "latest")],
        *[f"{p}_{m}" for m in optional for p in ("initial", "latest")],
        *[f"all_time_max_{m}" for m in mandatory[:5]],
        "latest_impact_year_range",
    )


def object_lifecycle(risk: DataFrame, bridge: DataFrame, as_of) -> DataFrame:
    """One row per risk object: first and last values, span, maxima, entity key if unique, activity.

    `as_of` is the clock: with the newest snapshot more than 48 hours older, activity is unknown.
    """
    return lifecycle_with_range(risk, bridge, as_of).drop("latest_impact_year_range")


def risk_by_entity(risk: DataFrame, bridge: DataFrame, as_of) -> DataFrame:
    """Lifecycles rolled up per entity; latest scalars only when exactly one risk object is linked."""
    lives = lifecycle_with_range(risk, bridge, as_of).filter(F.col("asteroid_key").isNotNull())
    one = F.count(F.lit(1)) == 1  # lives has one row per sentry_id
    scalars = {
        "sentry_id": "sentry_id",
        "latest_impact_probability": "latest_impact_probability",
        "latest_palermo_scale_max": "latest_palermo_scale_max",
        "latest_torino_scale_max": "latest_torino_scale_max",
        "potential_impacts_count": "latest_potential_impacts_count",
        "impact_year_range": "latest_impact_year_range",
        "is_currently_active": "is_currently_active",
    }
    return lives.groupBy("asteroid_key").agg(
        F.count(F.lit(1)).alias("sentry_identifier_count"),
        *[F.when(one, F.max(src)).alias(out) for out, src in scalars.items()],
        F.max("total_snapshots_observed").alias("total_snapshots_observed"),
        F.max("all_time_max_impact_probability").alias("all_time_max_impact_probability"),
        F.max("all_time_max_palermo_scale_max").alias("all_time_max_palermo_scale_max"),
        F.max("all_time_max_torino_scale_max").alias("all_time_max_torino_scale_max"),
        F.max("is_crosswalk_ambiguous").alias("is_crosswalk_ambiguous"),
    )


HISTORY_COLUMNS = [
    "snapshot_key", "snapshot_time", "sentry_id", "designation", "impact_probability", "palermo_scale_max",
    "palermo_scale_cum", "torino_scale_max", "potential_impacts_count", "v_infinity_km_s",
    "estimated_diameter_km", "absolute_magnitude", "impact_year_range", "last_obs_date",
]


def risk_history(risk: DataFrame, sentry_id: str | None = None) -> DataFrame:
    """Trajectories with one row per (snapshot, object): the newest run of a snapshot wins.

    All objects at once; a `sentry_id` restricts the scan itself.
    """
    if sentry_id is not None:
        risk = risk.filter(F.col("sentry_id") == sentry_id.strip())
    newest = latest_by(
        risk.select("run_id", *HISTORY_COLUMNS), ["snapshot_key", "sentry_id"], ["snapshot_time", "run_id"])
    seen = with_neighbours(
        newest, ["sentry_id"], ["snapshot_key"], ["impact_probability", "palermo_scale_max"],
        bucket=month_of("snapshot_key"))
    return seen.select(
        *HISTORY_COLUMNS,
        flag(F.col("impact_probability") != F.col("prev.impact_probability")).alias("is_impact_probability_changed"),
        flag(F.col("palermo_scale_max") != F.col("prev.palermo_scale_max")).alias("is_palermo_scale_max_changed"),
    )
