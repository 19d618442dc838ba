"""Traffic reports: day facts and visits, cubed over dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.events import IS_PAGE_VIEW
from footfall.functions.fields import Axis, encode
from footfall.functions.url import uri_host
from footfall.operators.cube import Cube
from footfall.operators.facts import fact_cells
from footfall.operators.page_flow import FLOW_MEASURES, page_flow
from footfall.operators.visits import VISIT_MEASURES, hourly_visits, visit_measures, visits
from footfall.sources.log import EVENTS, between_days

BASIC = ("pv", "visit_count", "uv", "ip_count", "visit_time", "bounce")
WITH_NEW = ("pv", "visit_count", "uv", "new_uv", "ip_count", "visit_time", "bounce")


@dataclass(frozen=True)
class Traffic:
    """Facts and visits of each group; a group exists where the day has events.

    Facts and visits share their dimension values and filters, so they are added up as cells of
    one cube instead of being cubed apart and joined. Page flow may name groups without events of
    their own; those fall away by `ip_count`, as a left join would drop them.
    """

    axes: tuple[Axis, ...]
    detail: Axis | None = None
    metrics: tuple[str, ...] = WITH_NEW
    hours: str | None = None  # "within": visits inside the hour; "look_back": first day per hour of day
    flow: bool = False

    def __call__(self, log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
        keys = ("stat_date", "stat_hour") if self.hours else ("stat_date",)
        cube = Cube(keys, self.axes, self.detail)
        rows = encode(log, cube.fields)
        if self.hours == "within":
            begun = hourly_visits(rows, cube.columns, first, last)
        else:
            begun = visits(rows, (*keys[1:], *cube.columns), first, last)
        begun = visit_measures(begun, (*cube.keys, *cube.columns))
        cells = fact_cells(between_days(rows, first, last), cube).unionByName(
            cube.open_cells(begun, tuple(VISIT_MEASURES)), allowMissingColumns=True
        )
        if self.flow:
            plain = tuple(field for axis in self.axes for field in axis.fields)
            names = tuple(field.name for field in plain)
            flow = page_flow(encode(log, plain), names, self.detail, first, last)
            cells = cells.unionByName(cube.open_cells(flow, tuple(FLOW_MEASURES)), allowMissingColumns=True)
        totals = cube.totals(cells, self.metrics)
        if self.hours:
            # Rows without an hour are no rows of an hourly report.
            totals = totals.filter("stat_hour <> ''")
        if not self.flow:
            return cube.report(totals, self.metrics)
        shown = cube.report(totals.filter("ip_count > 0"), self.metrics)
        return shown.selectExpr("*", f"{uri_host('url')} AS uri_host")


@dataclass(frozen=True)
class PageViews:
    """Page views of each group; `detail` and `second` as in a cube."""

    axes: tuple[Axis, ...]
    detail: Axis | None = None
    second: Axis | None = None

    def __call__(self, log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
        cube = Cube(("stat_date",), self.axes, self.detail, self.second)
        rows = encode(between_days(log, first, last), cube.fields)
        views = rows.selectExpr(*cube.keys, *cube.columns, f"CASE WHEN {IS_PAGE_VIEW} THEN {EVENTS} ELSE 0 END AS pv")
        if cube.details:
            # Summed per dimension tuple before they are copied; without details the totals do that.
            views = views.groupBy(*cube.keys, *cube.columns).agg(F.sum("pv").alias("pv"))
        return cube.report(cube.totals(cube.open_cells(views, ("pv",)), ("pv",)), ("pv",))
