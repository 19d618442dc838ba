"""Page flow: where sessions enter, leave and go on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.events import RAW_PAGE_EVENT
from footfall.functions.fields import Axis, encode
from footfall.operators.visits import DAY, HAS_SESSION, SESSION, visits
from footfall.sources.log import EVENTS, RAW, between_days

# From the two ends of a visit: hits of a page at that second (`now`), and until then in the session's day (`so_far`).
FLOW_MEASURES = {
    "entry_count": "CASE WHEN begins THEN now ELSE 0 END",
    "exit_count": "CASE WHEN begins THEN 0 ELSE now END",
    "down_pv_count": "CASE WHEN begins THEN - so_far ELSE so_far END",
}


def page_flow(
    log: DataFrame, keys: Sequence[str], page: Axis, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Per visit and page: page events at its first second, at its last, and after the first.

    The visit's span is taken per session and keys, the page events are matched by session alone: a session under two key tuples
    reports its pages under both. Events of one page in one second are merged; running sums of them over the seconds
    say at the ends of a span what lies in it, so that a span meets a page once, however often the session saw it.
    """
    events = log.filter(f"{RAW_PAGE_EVENT} AND {RAW}url <> ''")
    spans = visits(events, keys, first, last).drop("events")
    hits = (
        encode(between_days(events, first, last).filter(HAS_SESSION), page.fields)
        .groupBy(SESSION, DAY, *page.columns, "log_time")
        .agg(F.sum(EVENTS).alias("hits"))
    )
    ends = span_ends(spans, hits.select(SESSION, DAY, *page.columns).distinct(), keys, page)
    marked = hits.withColumn("is_end", F.lit(False)).unionByName(ends, allowMissingColumns=True)
    of_page = Window.partitionBy(SESSION, DAY, *page.columns)
    so_far = of_page.orderBy("log_time").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    now = of_page.orderBy("log_time").rangeBetween(Window.currentRow, Window.currentRow)
    summed = marked.select(
        DAY, *keys, *page.columns, "is_end", "begins",
        F.coalesce(F.sum("hits").over(so_far), F.lit(0)).alias("so_far"),
        F.coalesce(F.sum("hits").over(now), F.lit(0)).alias("now"),
    )
    return (
        summed.filter("is_end")
        .groupBy(DAY, *keys, *page.columns)
        .agg(*(F.expr(f"sum({value}) AS {name}") for name, value in FLOW_MEASURES.items()))
        .filter(" OR ".join(f"{name} > 0" for name in FLOW_MEASURES))
    )


def span_ends(spans: DataFrame, pages: DataFrame, keys: Sequence[str], page: Axis) -> DataFrame:
    """The two ends of each span for each page its session saw that day: as many pairs as (visit, page) can be counted."""
    pages = pages.withColumnsRenamed({SESSION: "hit_session", DAY: "hit_day"})
    return spans.join(pages, F.expr(f"hit_session = {SESSION} AND hit_day = {DAY}")).selectExpr(
        SESSION,
        DAY,
        *keys,
        *page.columns,
        "true AS is_end",
        "inline(array(struct(started AS log_time, true AS begins), struct(ended AS log_time, false AS begins)))",
    )
