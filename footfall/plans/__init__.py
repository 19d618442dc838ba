"""The reports by name: plan and output columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from footfall.functions.buckets import PAGE_VIEWS, VISIT_SECONDS, VISITS
from footfall.functions.fields import axis
from footfall.operators.cells import PAGE_CELLS, SESSION_CELLS, Cells
from footfall.operators.lifecycle import STAGES
from footfall.plans.dimensions import (
    COUNTRY,
    FIRST_DAY,
    FOLDED_SEARCH_WORD,
    LIB,
    MANUFACTURER,
    NAMED_CITY,
    NAMED_COUNTRY,
    NAMED_PROVINCE,
    PAGE,
    PAGE_TITLE,
    PAGE_URL,
    PROJECT,
    PROVINCE,
    REFERRER,
    SEARCH_WORD,
    SOURCE_SITE,
    STANDARD,
    STANDARD_NAMED,
)
from footfall.plans.histograms import PAGE_VIEW_HISTOGRAM, VISIT_HISTOGRAM, VISIT_HISTOGRAMS, VISIT_TIME_HISTOGRAM, lifecycle
from footfall.plans.traffic import BASIC, WITH_NEW, PageViews, Traffic
from footfall.plans.visitors import by_info, by_session, by_visitor
from footfall.sources.log import EARLIEST_DAY, EARLIEST_PAGE_DAY, event_log

Plan = Callable[[DataFrame, date | None, date | None], DataFrame]


@dataclass(frozen=True)
class Report:
    """`floor` is the day before which a full refresh does not begin, `cells` what a refresh rolls the report up from."""

    plan: Plan
    columns: tuple[str, ...]
    floor: date = EARLIEST_DAY
    cells: Cells = SESSION_CELLS  # what a refresh rolls it up from
    together: Plan | None = None  # what a refresh computes instead, for several reports: each takes its columns

    @property
    def shared(self) -> Plan:
        return self.together or self.plan


STD = ("stat_date", "lib", "project_name", "is_first_day", "country", "province")
LIB_PROJECT = (axis(LIB), axis(PROJECT))
_STANDARD_TRAFFIC = Traffic(STANDARD)

REPORTS: dict[str, Report] = {
    "flow_summary_bydate": Report(
        Traffic(LIB_PROJECT, metrics=BASIC), ("stat_date", "lib", "project_name", *BASIC)
    ),
    "flow_summary_byhour": Report(
        Traffic(LIB_PROJECT, metrics=BASIC, hours="within"),
        ("stat_date", "stat_hour", "lib", "project_name", *BASIC),
    ),
    "flow_trend_bydate": Report(_STANDARD_TRAFFIC, (*STD, *WITH_NEW)),
    "flow_trend_byhour": Report(
        Traffic(STANDARD, hours="look_back"), ("stat_date", "stat_hour", *STD[1:], *WITH_NEW)
    ),
    "visitor_summary_bydate": Report(
        Traffic((axis(FIRST_DAY), *LIB_PROJECT), metrics=BASIC),
        ("stat_date", "is_first_day", "lib", "project_name", *BASIC),
    ),
    "visitor_detail_bydate": Report(_STANDARD_TRAFFIC, (*STD, *WITH_NEW)),
    "channel_detail_bydate": Report(_STANDARD_TRAFFIC, (*STD, *WITH_NEW)),
    "area_detail_bydate": Report(Traffic(STANDARD_NAMED, axis(NAMED_CITY)), (*STD, "city", *WITH_NEW)),
    "area_summary_bydate": Report(
        PageViews((*LIB_PROJECT, axis(NAMED_COUNTRY), axis(NAMED_PROVINCE))),
        ("stat_date", "lib", "project_name", "country", "province", "pv"),
    ),
    "device_detail_bydate": Report(Traffic(STANDARD, axis(MANUFACTURER)), (*STD, "manufacturer", *WITH_NEW)),
    "searchword_detail_bydate": Report(
        Traffic(STANDARD, axis(SEARCH_WORD)), (*STD, "latest_search_keyword", *WITH_NEW)
    ),
    "searchword_summary_bydate": Report(
        PageViews(LIB_PROJECT, axis(FOLDED_SEARCH_WORD)),
        ("stat_date", "lib", "project_name", "latest_search_keyword", "pv"),
    ),
    "sourcesite_detail_bydate": Report(
        Traffic(STANDARD, axis(REFERRER)), (*STD, "latest_referrer_host", *WITH_NEW)
    ),
    "sourcesite_summary_bydate": Report(
        PageViews(LIB_PROJECT, axis(SOURCE_SITE)),
        ("stat_date", "lib", "project_name", "sourcesite", "pv"),
    ),
    "visituri_detail_bydate": Report(
        Traffic(STANDARD, PAGE, metrics=(*WITH_NEW, "entry_count", "exit_count", "down_pv_count"), flow=True),
        (*STD, *PAGE.columns, "uri_host", *WITH_NEW, "entry_count", "exit_count", "down_pv_count"),
        floor=EARLIEST_PAGE_DAY,
        cells=PAGE_CELLS,
    ),
    "visituri_summary_bydate": Report(
        PageViews(LIB_PROJECT, axis(PAGE_URL), axis(PAGE_TITLE)),
        ("stat_date", "lib", "project_name", "url", "title", "pv"),
        cells=PAGE_CELLS,
    ),
    "user_pv_bydate": Report(PAGE_VIEW_HISTOGRAM, (*STD, *PAGE_VIEWS)),
    "user_visit_bydate": Report(VISIT_HISTOGRAM, (*STD, *VISITS), together=VISIT_HISTOGRAMS),
    "user_visittime_bydate": Report(VISIT_TIME_HISTOGRAM, (*STD, *VISIT_SECONDS), together=VISIT_HISTOGRAMS),
    "visitor_life_bydate": Report(
        lifecycle, ("stat_date", "lib", "project_name", "country", "province", *STAGES)
    ),
    "visitor_summary_byvisitor": Report(by_visitor, (*STD, "distinct_id", *WITH_NEW, "latest_time")),
    "visitor_detail_byinfo": Report(
        by_info,
        (
            *STD,
            "city",
            "distinct_id",
            "client_ip",
            "manufacturer",
            "latest_time",
            "first_time",
            "visit_time",
            "visit_count",
            "pv",
        ),
    ),
    "visitor_detail_bysession": Report(
        by_session,
        (
            "stat_date",
            "project_name",
            "country",
            "province",
            "client_ip",
            "sourcesite",
            "searchword",
            "distinct_id",
            "event_session_id",
            "first_time",
            "latest_time",
            "visit_time",
            "pv",
        ),
    ),
}


def report(name: str, log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """The report `name` over a table of tracked events, or of their cells, for the days first..last or for all its days.

    A given first day also needs the days of its look-back in `log`.
    """
    chosen = REPORTS[name]
    return chosen.plan(event_log(log), first, last).select(*chosen.columns)
