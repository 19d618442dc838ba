"""Refresh stored reports: one day, a range of days, or the whole history.

A refresh reads the log once for each family of reports: the days it computes are merged into cells (`operators/cells.py`), which
are kept by day, and all reports are rolled up from those. Days that reports look back to are read as the cells that
earlier refreshes kept; a day that has none is read from the log with the others.

Cells and reports are versioned tables (`sources/versions.py`): the rows of a refresh count all at once when it commits a table, and
where two refreshes overlap, the one that began later stays. A day that comes out empty is empty in the table, and a full
refresh leaves no other days. One that fails leaves what was there.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager, nullcontext
from datetime import date, datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.model import VISIT_LOOK_BACK
from footfall.operators.cells import Cells
from footfall.plans import REPORTS, report
from footfall.sources import versions
from footfall.sources.log import between_days, earliest_day, earliest_partition, event_log


def refresh_day(
    log: DataFrame, only: date, database: str, names: Iterable[str] = REPORTS, keep: StorageLevel | None = None
) -> None:
    """Recompute one day: reads that day of the log, and the cells of the days it looks back to."""
    refresh_days(log, only, only, database, names, keep)


def refresh_days(
    log: DataFrame,
    first: date,
    last: date,
    database: str,
    names: Iterable[str] = REPORTS,
    keep: StorageLevel | None = None,
) -> None:
    """Recompute the days first..last, both included, in one pass over these days of the log for each family of reports.

    `keep` holds the cells of these days and their look-back while all reports read them, where the cluster has room for that.
    """
    if last < first:
        raise ValueError(f"last day {last} lies before first day {first}")
    _refresh(log, dict.fromkeys(names, first), last, database, everything=False, keep=keep)


def refresh_full(
    log: DataFrame | str,
    database: str,
    names: Iterable[str] = REPORTS,
    today: date | None = None,
    floor: date | None = None,
    keep: StorageLevel | None = None,
) -> None:
    """Replace the whole tables by the days from the log's first one until today.

    `log` may be the name of a table: then its first day is taken from its partitions, without reading it. Days before `floor` are
    left out; by default each report has its own (`EARLIEST_DAY`, `EARLIEST_PAGE_DAY`).
    """
    last = today or date.today()
    spark = SparkSession.active()
    starts: dict[date, date] = {}
    firsts = {}
    for name in names:
        lowest = floor or REPORTS[name].floor
        if lowest not in starts:
            found = earliest_partition(spark, log, lowest) if isinstance(log, str) else earliest_day(log, lowest)
            starts[lowest] = found or lowest
        firsts[name] = min(starts[lowest], last)
    _refresh(spark.table(log) if isinstance(log, str) else log, firsts, last, database, everything=True, keep=keep)


def _refresh(
    log: DataFrame, firsts: dict[str, date], last: date, database: str, everything: bool, keep: StorageLevel | None
) -> None:
    version = versions.new_version()
    families: dict[Cells, list[str]] = {}
    for name in firsts:
        families.setdefault(REPORTS[name].cells, []).append(name)
    for cells, names in families.items():
        first = min(firsts[name] for name in names)
        days = _updated(log, cells, first, last, database, version, everything)
        with _kept(days, keep) if keep else nullcontext(days) as merged:
            _store_reports(merged, {name: firsts[name] for name in names}, last, database, version, everything)


def _updated(log: DataFrame, cells: Cells, first: date, last: date, database: str, version: int, everything: bool) -> DataFrame:
    """The cells of the days first..last, made anew from the log, and of their look-back, kept from before where they are."""
    spark, table = log.sparkSession, f"{database}.{cells.table}"
    begin = first - timedelta(days=VISIT_LOOK_BACK)
    before = _days(begin, first - timedelta(days=1))
    kept = set() if everything else versions.committed_days(spark, table, begin, first)
    missing = [day for day in before if day not in kept]
    wanted = between_days(log, missing[0] if missing else first, last)
    if kept & set(before):
        wanted = wanted.filter(F.col("stat_date").isin(missing) | (F.col("stat_date") >= first))
    versions.write(cells.of(wanted), table, version, cells.order)
    versions.commit(spark, table, version, [*missing, *_days(first, last)], everything)
    return between_days(spark.table(table), begin, last)


def _days(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def _store_reports(cells: DataFrame, firsts: dict[str, date], last: date, database: str, version: int, everything: bool) -> None:
    # Reports of a shared plan and range are computed once and written to each of their tables.
    alike: dict[tuple, list[str]] = {}
    for name, first in firsts.items():
        alike.setdefault((id(REPORTS[name].shared), first), []).append(name)
    for (_, first), names in alike.items():
        if len(names) == 1:
            store(report(names[0], cells, first, last), f"{database}.{names[0]}", _days(first, last), version, everything)
            continue
        with _kept(REPORTS[names[0]].shared(event_log(cells), first, last), StorageLevel.MEMORY_AND_DISK) as result:
            for name in names:
                store(result.select(*REPORTS[name].columns), f"{database}.{name}", _days(first, last), version, everything)


@contextmanager
def _kept(rows: DataFrame, level: StorageLevel):
    kept = rows.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def store(rows: DataFrame, table: str, days: list[date], version: int | None = None, everything: bool = False) -> None:
    """Write report rows into `table` in place of `days`, or of all days with `everything`.

    `version` is when the rows' refresh began, now by default: it decides between writes that overlap.
    """
    spark = rows.sparkSession
    version = version or versions.new_version()
    started = datetime.fromtimestamp(version // 1_000_000_000, timezone.utc)
    ordered = [*(name for name in rows.columns if name != "stat_date"), "update_time", "stat_date"]
    versions.write(rows.withColumn("update_time", F.lit(started)).select(*ordered), table, version)
    versions.commit(spark, table, version, days, everything)
