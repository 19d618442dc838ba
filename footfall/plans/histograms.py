"""Visitor histograms and lifecycle: distinct visitors of each class, cubed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.buckets import PAGE_VIEWS, VISIT_SECONDS, VISITS, bucket_of
from footfall.functions.events import IS_PAGE_VIEW
from footfall.functions.fields import Axis, Field, axis, encode
from footfall.operators.cube import Cube
from footfall.operators.lifecycle import STAGES, active_rows, visitor_stages
from footfall.operators.visits import VISIT_MEASURES, visits
from footfall.plans.dimensions import COUNTRY, PROVINCE, STANDARD
from footfall.sources.log import EVENTS, between_days, day

VISITOR = "distinct_id"
RAW_KEYS = tuple(name for one in STANDARD for name in one.columns)


def page_views_per_visitor(log: DataFrame, first: date | None, last: date | None) -> DataFrame:
    rows = between_days(log, first, last)
    return rows.groupBy("stat_date", *RAW_KEYS, VISITOR).agg(F.expr(f"coalesce(sum({EVENTS}) FILTER (WHERE {IS_PAGE_VIEW}), 0) AS value"))


def _visits_per_visitor(log: DataFrame, first: date | None, last: date | None, measure: str) -> DataFrame:
    begun = visits(log, (*RAW_KEYS, VISITOR), first, last)
    return begun.groupBy("stat_date", *RAW_KEYS, VISITOR).agg(F.expr(f"sum({VISIT_MEASURES[measure]}) AS value"))


def visits_per_visitor(log: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Visits have the session in their key, so counting them counts distinct sessions."""
    return _visits_per_visitor(log, first, last, "visit_count")


def visit_seconds_per_visitor(log: DataFrame, first: date | None, last: date | None) -> DataFrame:
    return _visits_per_visitor(log, first, last, "visit_time")


def visits_and_seconds_per_visitor(log: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Both at once: how many visits, and their seconds."""
    begun = visits(log, (*RAW_KEYS, VISITOR), first, last)
    return begun.groupBy("stat_date", *RAW_KEYS, VISITOR).agg(
        F.expr(f"sum({VISIT_MEASURES['visit_count']}) AS visits"), F.expr(f"sum({VISIT_MEASURES['visit_time']}) AS seconds")
    )


@dataclass(frozen=True)
class Histogram:
    """Distinct visitors per value range.

    The range is that of the visitor's value under the full dimension tuple; a visitor with
    several tuples may stand in several ranges of a total. Several values (`others`, each with ranges of its own) make
    histograms beside each other: a visitor's row stands once for each, and they go through one cube.
    """

    values: Callable[[DataFrame, date | None, date | None], DataFrame]
    buckets: tuple[tuple[str, int], ...]
    axes: tuple[Axis, ...] = STANDARD
    value: str = "value"
    others: tuple[tuple[str, tuple[tuple[str, int], ...]], ...] = ()

    def __call__(self, log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
        cube = Cube(("stat_date",), self.axes)
        ranges = dict(self.buckets) | {name: least for _, buckets in self.others for name, least in buckets}
        classed = [bucket_of(value, dict(buckets)) for value, buckets in ((self.value, self.buckets), *self.others)]
        bucket = f"explode(array({', '.join(classed)}))" if self.others else classed[0]
        visitors = encode(self.values(log, first, last), cube.fields).selectExpr(
            *cube.keys, *cube.columns, VISITOR, f"{bucket} AS bucket", "1 AS visitors"
        )
        leaves = cube.leaves(visitors, (VISITOR, "bucket", "visitors"))
        cells = cube.distinct_cells(leaves, (VISITOR,), flags=("visitors",), keys=("bucket",))
        wide = cells.selectExpr("*", *(f"CASE WHEN bucket = '{name}' THEN visitors END AS {name}" for name in ranges))
        return cube.report(cube.totals(wide, tuple(ranges)), tuple(ranges))


PAGE_VIEW_HISTOGRAM = Histogram(page_views_per_visitor, tuple(PAGE_VIEWS.items()))
VISIT_HISTOGRAM = Histogram(visits_per_visitor, tuple(VISITS.items()))
VISIT_TIME_HISTOGRAM = Histogram(visit_seconds_per_visitor, tuple(VISIT_SECONDS.items()))
# What a refresh computes for both tables; the groups of either are those that have visits.
VISIT_HISTOGRAMS = Histogram(
    visits_and_seconds_per_visitor,
    tuple(VISITS.items()),
    value="visits",
    others=(("seconds", tuple(VISIT_SECONDS.items())),),
)

LIFECYCLE_AXES = (
    axis(Field("lib", unknown=("",), label=None)),
    axis(Field("project_name", unknown=("",))),
    axis(COUNTRY),
    axis(PROVINCE),
)


def lifecycle(log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Distinct visitors per lifecycle stage; without `last`, days end with the log's last one."""
    cube = Cube(("stat_date",), LIFECYCLE_AXES)
    end = F.expr(day(last)) if last is not None else log.selectExpr("max(stat_date)").scalar()
    stages = visitor_stages(encode(active_rows(log, first, last), cube.fields), cube.columns, first, end)
    cells = cube.distinct_cells(cube.leaves(stages, (VISITOR, *STAGES)), (VISITOR,), flags=tuple(STAGES))
    return cube.report(cube.totals(cells, tuple(STAGES)), tuple(STAGES))
