"""Snapshot-to-snapshot change: flags, coverage gaps and presence states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.vocabulary import EXIT, NEW_ENTRY, PERSISTENT, RE_ENTRY


def flag(condition: Column) -> Column:
    """True only where the condition holds; unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True if some pair is known to differ."""
    changed = F.lit(False)
    for now, before in pairs:
        changed = changed | flag(now != before)
    return changed


def coverage_gap(previous_key: Column, steps: Column, days: Column) -> Column:
    """True when fewer snapshots than calendar days separate two appearances of an object."""
    return flag(previous_key.isNotNull() & (days != 1) & (steps < days))


def presence_state(
    previous_key: Column, steps: Column, days: Column,
    next_step: Column, following_key: Column, following_days: Column,
) -> Column:
    """Ordered classification; a gap wins over an exit, an exit over a first appearance.

    `steps`/`days` lead back to the object's previous row, `next_step` forward to its next one in
    the snapshot sequence, and the two `following_*` describe the next snapshot of the whole table.
    """
    resumed = previous_key.isNotNull() & (steps < days)
    left = following_key.isNotNull() & (following_days == 1) & (next_step.isNull() | (next_step > 1))
    return (
        F.when(resumed, F.lit(None).cast("string"))
        .when(left, F.lit(EXIT))
        .when(previous_key.isNull(), F.lit(NEW_ENTRY))
        .when((steps == 1) & (days == 1), F.lit(PERSISTENT))
        .when((steps == days) & (steps > 1), F.lit(RE_ENTRY))
    )
