"""The building blocks on their own, each over a whole log: what the reports are made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.events import IS_ACTIVITY, IS_NEW_PAGE_VIEW, IS_PAGE_EVENT, IS_PAGE_VIEW
from footfall.functions.fields import encode
from footfall.functions.url import uri_host
from footfall.model import LIFECYCLE_LOOK_BACK, VISIT_LOOK_BACK
from footfall.operators.cube import Cube
from footfall.operators.facts import fact_cells
from footfall.operators.lifecycle import STAGES, active_rows, visitor_stages
from footfall.operators.page_flow import FLOW_MEASURES, page_flow
from footfall.operators.visits import SECONDS, SESSION, VISIT_MEASURES, hourly_visits, visit_measures, visits
from footfall.plans.dimensions import NAMED_COUNTRY, NAMED_PROVINCE, PAGE, REFERRER, SEARCH_WORD, STANDARD
from footfall.plans.histograms import page_views_per_visitor, visit_seconds_per_visitor, visits_per_visitor
from footfall.sources.log import EARLIEST_DAY, EARLIEST_PAGE_DAY, between_days, event_log

LIB, PROJECT = STANDARD[:2]
VISIT_KEYS = ("lib", "project_name", "is_first_day")


def event_classes(log: DataFrame) -> DataFrame:
    """Events per day, library and event name, and how many count as what."""
    classes = {
        "page_views": IS_PAGE_VIEW,
        "new_page_views": IS_NEW_PAGE_VIEW,
        "activities": IS_ACTIVITY,
        "page_events": IS_PAGE_EVENT,
    }
    return log.groupBy("stat_date", "lib", "event").agg(
        F.count("*").alias("events"), *(F.expr(f"count_if({rule}) AS {name}") for name, rule in classes.items())
    )


def dimension_values(log: DataFrame) -> DataFrame:
    """Events per folded and labelled place and referrer, without excluded markers."""
    fields = (NAMED_COUNTRY, NAMED_PROVINCE, REFERRER, SEARCH_WORD)
    counted = encode(log, fields).groupBy(*(field.name for field in fields)).agg(F.count("*").alias("events"))
    return counted.selectExpr(*(f"{field.labelled()} AS {field.name}" for field in fields), "events")


def session_visits(log: DataFrame) -> DataFrame:
    """Each visit with its day, span and events."""
    return visits(log, VISIT_KEYS).selectExpr(
        "stat_date", SESSION, *VISIT_KEYS, "started", "ended", "events", f"{SECONDS} AS seconds"
    )


def session_hours(log: DataFrame) -> DataFrame:
    """Each hour of a session with its span and events."""
    return hourly_visits(log, VISIT_KEYS).selectExpr(
        "stat_date", "stat_hour", SESSION, *VISIT_KEYS, "started", "ended", "events", f"{SECONDS} AS seconds"
    )


def visit_totals(log: DataFrame) -> DataFrame:
    """Visits, seconds and bounces, cubed over library and project, with the bits of what is rolled up."""
    cube = Cube(("stat_date",), (LIB, PROJECT))
    measured = visit_measures(visits(log, cube.columns), (*cube.keys, *cube.columns))
    totals = cube.totals(cube.open_cells(measured, tuple(VISIT_MEASURES)), tuple(VISIT_MEASURES))
    return totals.selectExpr("rolled AS rolled_bits", "*").drop("rolled")


def distinct_totals(log: DataFrame) -> DataFrame:
    """Page views and exact unique visitors, new visitors and addresses, cubed over library and project."""
    cube = Cube(("stat_date",), (LIB, PROJECT))
    measures = ("pv", "uv", "new_uv", "ip_count")
    return cube.report(cube.totals(fact_cells(log, cube), measures), measures)


def page_totals(log: DataFrame) -> DataFrame:
    """Events cubed over library and page, the page's address, path and title rolled up as one."""
    cube = Cube(("stat_date",), (LIB, PAGE))
    rows = encode(log, cube.fields).selectExpr(*cube.keys, *cube.columns, "1 AS events")
    return cube.report(cube.totals(cube.open_cells(rows, ("events",)), ("events",)), ("events",))


def visitor_values(log: DataFrame) -> DataFrame:
    """Page views, visits and visit seconds of each visitor and dimension tuple: what histograms class."""
    keys = ["stat_date", *(name for axis in STANDARD for name in axis.columns), "distinct_id"]
    views = page_views_per_visitor(log, None, None).withColumnRenamed("value", "page_views")
    begun = visits_per_visitor(log, None, None).withColumnRenamed("value", "visits")
    seconds = visit_seconds_per_visitor(log, None, None).withColumnRenamed("value", "seconds")
    parts = views.unionByName(begun, allowMissingColumns=True).unionByName(seconds, allowMissingColumns=True)
    return parts.groupBy(*keys).agg(
        *(F.sum(name).cast("long").alias(name) for name in ("page_views", "visits", "seconds"))
    )


def lifecycle_stages(log: DataFrame) -> DataFrame:
    """Per day, library and visitor, the stages reached."""
    end = log.selectExpr("max(stat_date)").scalar()
    return visitor_stages(active_rows(log, None, None), ("lib",), None, end).selectExpr(
        "stat_date", "lib", "distinct_id", *(f"CAST({name} AS BIGINT) AS {name}" for name in STAGES)
    )


def session_pages(log: DataFrame) -> DataFrame:
    """Entries, exits and onward views per day, library and page."""
    flow = page_flow(log, ("lib",), PAGE)
    return flow.selectExpr(
        "stat_date", "lib", *PAGE.columns, *(f"CAST(coalesce({n}, 0) AS BIGINT) AS {n}" for n in FLOW_MEASURES)
    )


def page_hosts(log: DataFrame) -> DataFrame:
    """Events per address and its site."""
    counted = log.groupBy("url").agg(F.count("*").alias("events"))
    return counted.selectExpr("url", f"{uri_host('url')} AS uri_host", "events")


def report_days(log: DataFrame) -> DataFrame:
    """Each day with data, the days its reports look back to, and the day after it."""
    days = log.select("stat_date").distinct()
    return days.selectExpr(
        "stat_date",
        "date_format(stat_date, 'yyyy-MM-dd') AS day_text",
        f"date_sub(stat_date, {VISIT_LOOK_BACK}) AS visits_from",
        f"date_sub(stat_date, {LIFECYCLE_LOOK_BACK}) AS lifecycle_from",
        "date_add(stat_date, 1) AS next_day",
    )


def earliest_days(log: DataFrame) -> DataFrame:
    """First day a full refresh computes: of the reports, and of the page report."""
    rules = {"reports_from": EARLIEST_DAY, "page_report_from": EARLIEST_PAGE_DAY}
    return between_days(log, min(rules.values()), None).agg(
        *(F.expr(f"min(stat_date) FILTER (WHERE stat_date >= DATE'{floor}') AS {name}") for name, floor in rules.items())
    )


PARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    part.__name__: part
    for part in (
        event_classes,
        dimension_values,
        session_visits,
        session_hours,
        visit_totals,
        distinct_totals,
        page_totals,
        visitor_values,
        lifecycle_stages,
        session_pages,
        page_hosts,
        report_days,
        earliest_days,
    )
}


def part(name: str, log: DataFrame) -> DataFrame:
    """The building block `name` over a table of tracked events."""
    return PARTS[name](event_log(log))
