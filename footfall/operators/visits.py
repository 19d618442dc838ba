"""Visits: what one session did under one set of dimension values, on the day it began."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.model import VISIT_LOOK_BACK
from footfall.sources.log import ENDED, EVENTS, RAW, STARTED, between_days, day

SESSION = "event_session_id"
DAY = "stat_date"
HAS_SESSION = f"{RAW}{SESSION} <> ''"
# Subtracted as they stand: a session zone with summer time must not add or lose an hour.
SECONDS = "CAST(CAST(ended - started AS INTERVAL SECOND) AS BIGINT)"

# Per visit, the numbers that add up over visits; a bounce is a visit of a single event.
VISIT_MEASURES = {
    "visit_count": "1",
    "visit_time": SECONDS,
    "bounce": "CAST(events = 1 AS INT)",
}


def visits(
    log: DataFrame,
    keys: Sequence[str],
    first: date | None = None,
    last: date | None = None,
    look_back: int = VISIT_LOOK_BACK,
) -> DataFrame:
    """One row per visit: session, keys, day, started, ended, events.

    A session counts on day D when D is its first day within D-7..D. Later days of the range do
    not matter for D, so all rows of a counted visit lie on D itself. Over many days that means:
    reduce to session days, then keep a day with no earlier one, or none in the look-back. That
    reads the log once, where going day by day reads each row eight times.
    """
    rows = between_days(log, first, last, look_back).filter(HAS_SESSION)
    if first is not None and first == last:
        # One day: its visits are the groups whose first day it is, without a second shuffle.
        groups = rows.groupBy(SESSION, *keys).agg(F.min(DAY).alias(DAY), *_span())
        return groups.filter(f"{DAY} = {day(first)}")
    session_days = rows.groupBy(SESSION, *keys, DAY).agg(*_span())
    # A window holds the days of one session: partial aggregation has already merged its events.
    window = f"PARTITION BY {', '.join((SESSION, *keys))} ORDER BY {DAY}"
    dated = session_days.selectExpr("*", f"lag({DAY}) OVER ({window}) AS earlier")
    began = dated.filter(f"earlier IS NULL OR date_diff({DAY}, earlier) > {look_back}").drop("earlier")
    return between_days(began, first, last)


def hourly_visits(
    log: DataFrame, keys: Sequence[str], first: date | None = None, last: date | None = None
) -> DataFrame:
    """Visits within an hour of a day: a session counts in every hour in which it has events."""
    rows = between_days(log, first, last).filter(HAS_SESSION)
    return rows.groupBy(SESSION, *keys, "stat_hour", DAY).agg(*_span())


def _span():
    return (
        F.min(STARTED).alias("started"),
        F.max(ENDED).alias("ended"),
        F.sum(EVENTS).alias("events"),
    )


def visit_measures(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    return found.selectExpr(*keys, *(f"{value} AS {name}" for name, value in VISIT_MEASURES.items()))
