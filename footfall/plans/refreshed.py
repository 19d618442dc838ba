"""Refreshes as queries: store reports in the ways a user would, and read back what is stored.

Every call makes a database of its own, named `footfall_<random>`, in the session's warehouse; whoever runs these queries drops it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame

from footfall.plans import report
from footfall.refresh import refresh_day, refresh_days, refresh_full

FULL, RANGES, DAYS, AGAIN = "flow_summary_bydate", "user_visit_bydate", "visitor_life_bydate", "area_summary_bydate"


def _ends(log: DataFrame) -> tuple[date, date]:
    row = log.selectExpr("min(stat_date)", "max(stat_date)").first()
    return row[0], row[1]


def _database(log: DataFrame) -> str:
    name = f"footfall_{uuid.uuid4().hex}"
    log.sparkSession.sql(f"CREATE DATABASE {name}")
    return name


def _stored(log: DataFrame, database: str, name: str) -> DataFrame:
    return log.sparkSession.table(f"{database}.{name}").drop("update_time")


def refreshed_in_full(log: DataFrame) -> DataFrame:
    """A full refresh over what two days, one of them without any event, had stored before."""
    database, (first, last) = _database(log), _ends(log)
    for day in (first, last + timedelta(days=40)):
        refresh_day(log, day, database, [FULL])
    refresh_full(log, database, [FULL], today=last)
    return _stored(log, database, FULL)


def refreshed_in_ranges(log: DataFrame) -> DataFrame:
    """Two ranges that overlap, the later one first; its look-back is read from the log, the other's from what it left."""
    database, (first, last) = _database(log), _ends(log)
    middle = first + (last - first) // 2
    refresh_days(log, middle, last, database, [RANGES])
    refresh_days(log, first, min(last, middle + timedelta(days=2)), database, [RANGES])
    return _stored(log, database, RANGES)


def refreshed_by_day(log: DataFrame) -> DataFrame:
    """All but the last days in one range, then day by day, each from a log that has no other day."""
    database, (first, last) = _database(log), _ends(log)
    since = max(first, last - timedelta(days=2))
    if since > first:
        refresh_days(log, first, since - timedelta(days=1), database, [DAYS])
    for number in range((last - since).days + 1):
        day = since + timedelta(days=number)
        refresh_day(log.filter(f"stat_date = DATE'{day}'"), day, database, [DAYS])
    return _stored(log, database, DAYS)


def refreshed_again(log: DataFrame) -> DataFrame:
    """The same range twice, first over a log that still has events which are gone the second time."""
    database, (first, last) = _database(log), _ends(log)
    refresh_days(log.unionByName(log.selectExpr("* EXCEPT (lib)", "'gone' AS lib")), first, last, database, [AGAIN])
    refresh_days(log, first, last, database, [AGAIN])
    return _stored(log, database, AGAIN)


def last_day_of(name: str) -> Callable[[DataFrame], DataFrame]:
    def last_day(log: DataFrame) -> DataFrame:
        _, last = _ends(log)
        return report(name, log, last, last)

    return last_day


#: Query -> the report whose rows it stores and reads back.
REFRESHED: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "refreshed_in_full": (FULL, refreshed_in_full),
    "refreshed_in_ranges": (RANGES, refreshed_in_ranges),
    "refreshed_by_day": (DAYS, refreshed_by_day),
    "refreshed_again": (AGAIN, refreshed_again),
}
#: Reports of the log's last day alone.
LAST_DAY = ("flow_trend_byhour", "user_visittime_bydate", "visitor_detail_bysession")
#: Reports over a log in which libraries, projects and first-day flags may be empty.
BLANK = ("flow_summary_bydate", "visitor_summary_bydate", "visitor_summary_byvisitor")
