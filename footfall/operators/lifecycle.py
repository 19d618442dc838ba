"""Visitor lifecycle: new, continuous, returning, silent and lost visitors of a day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.events import RAW_ACTIVITY
from footfall.model import LIFECYCLE_LOOK_BACK
from footfall.sources.log import between_days

# Per visitor and report day, its stages as 0/1; whoever is in the look-back has one at least.
STAGES = {
    "new_users": "is_new",
    "continuous_active_users": "today * yesterday",
    "revisit_users": "today * (1 - yesterday)",
    "silent_users": "(1 - today) * yesterday",
    "churn_users": "(1 - today) * (1 - yesterday)",
}


def active_rows(log: DataFrame, first: date | None, last: date | None) -> DataFrame:
    return between_days(log, first, last, LIFECYCLE_LOOK_BACK).filter(RAW_ACTIVITY)


#: A visitor's days are bits of a number, so many days to a row; the days looked back to from its first ones come before them.
DAYS_TOGETHER = 32


def activity_bits(active: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per keys, visitor and block of days: `bits`, on which days there was activity, and `fresh`, on which of them as new.

    Bit LIFECYCLE_LOOK_BACK is the block's first day. Bits are merged on the map side, in a single shuffle; only a block's last
    days also stand in the block after it.
    """
    block, place = f"CAST(floor(n / {DAYS_TOGETHER}) AS INT)", f"pmod(n, {DAYS_TOGETHER})"
    both = f"CASE WHEN {place} >= {DAYS_TOGETHER - LIFECYCLE_LOOK_BACK} THEN array({block}, {block} + 1) ELSE array({block}) END"
    days = active.selectExpr(*keys, "distinct_id", "unix_date(stat_date) AS n", "is_first_day = 'true' AS is_fresh")
    placed = days.selectExpr("*", f"explode({both}) AS block").selectExpr(
        *keys, "distinct_id", "is_fresh", "block", f"shiftleft(1L, n - block * {DAYS_TOGETHER} + {LIFECYCLE_LOOK_BACK}) AS bit"
    )
    return placed.groupBy(*keys, "distinct_id", "block").agg(
        F.expr("bit_or(bit) AS bits"), F.expr("bit_or(CASE WHEN is_fresh THEN bit ELSE 0L END) AS fresh")
    )


def visitor_stages(active: DataFrame, keys: Sequence[str], first: date | None, last: Column) -> DataFrame:
    """Per report day, keys and visitor: 0/1 for each stage.

    A report day sees its own bit and those of the days before it; it has a row where any of them is set. A day without
    events still has silent and lost visitors, up to the day `last`.
    """
    back = LIFECYCLE_LOOK_BACK
    seen = f"filter(sequence({back}, {back + DAYS_TOGETHER - 1}), p -> shiftright(bits, p - {back}) & {(2 << back) - 1} <> 0)"
    rows = activity_bits(active, keys).selectExpr("*", f"explode({seen}) AS p")
    days = rows.selectExpr(
        f"date_from_unix_date(block * {DAYS_TOGETHER} + p - {back}) AS stat_date",
        *keys,
        "distinct_id",
        "CAST(shiftright(bits, p) & 1 AS INT) AS today",
        "CAST(shiftright(bits, p - 1) & 1 AS INT) AS yesterday",
        "CAST(shiftright(fresh, p) & 1 AS INT) AS is_new",
    )
    told = between_days(days.filter(F.col("stat_date") <= last), first, None)
    return told.selectExpr("stat_date", *keys, "distinct_id", *(f"{rule} AS {name}" for name, rule in STAGES.items()))
