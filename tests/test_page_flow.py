"""Entries, exits and onward views against counting every visit and hit."""

from __future__ import annotations

from collections import Counter, defaultdict

from footfall.functions.fields import Field, axis
from footfall.operators.page_flow import page_flow, span_ends
from footfall.operators.visits import visits
from footfall.sources.log import event_log
from tests.logs import event, log_of, random_events
from tests.test_plans import plan_of

PAGE = axis(Field("url"))
PAGES = ("$pageview", "$AppViewScreen", "$MPViewScreen")


def brute_force(events, keys):
    shown = [e for e in events if e["event"] in PAGES and e["url"] and e["event_session_id"]]
    days = defaultdict(set)
    for e in shown:
        days[e["event_session_id"], *(e[k] for k in keys)].add(e["stat_date"])
    found = Counter()
    for (session, *values), seen in days.items():
        for day in seen:
            if any(0 < (day - other).days <= 7 for other in seen):
                continue
            own = [e["log_time"] for e in shown if e["event_session_id"] == session and [e[k] for k in keys] == values and e["stat_date"] == day]
            first, last = min(own), max(own)
            for e in shown:
                if e["event_session_id"] == session and e["stat_date"] == day and first <= e["log_time"] <= last:
                    at = (day, *values, e["url"])
                    found[at, "entry"] += e["log_time"] == first
                    found[at, "exit"] += e["log_time"] == last
                    found[at, "down"] += e["log_time"] > first
    return {at: tuple(found[at, kind] for kind in ("entry", "exit", "down")) for at, _ in found}


def counted(rows, keys):
    return {(r["stat_date"], *(r[k] for k in keys), r["url"]): (r["entry_count"], r["exit_count"], r["down_pv_count"]) for r in rows.collect()}


def test_page_flow_against_brute_force(spark):
    events = random_events(seed=21, rows=260, days=11)
    events += [event(3, "10:00:00", url="https://a/1"), event(3, "10:00:00", url="https://a/1"), event(3, "10:00:00", url="https://a/2", lib="iOS")]
    log = event_log(log_of(spark, *events)).cache()
    for keys in (("lib", "project_name"), ("is_first_day",)):
        wanted = brute_force(events, keys)
        assert wanted and counted(page_flow(log, keys, PAGE), keys) == wanted


def test_a_session_of_many_long_spans_meets_each_page_once(spark):
    """2,000 visitors' worth of key tuples share a session, all through a day of 1,500 hits on two pages."""
    log = event_log(
        spark.range(4000).selectExpr(
            "DATE'2024-01-01' AS stat_date",
            "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, if(id % 2 = 0, id div 2, 50000 + id div 2)) AS log_time",
            "'js' AS lib", "'$pageview' AS event", "concat('p', id div 2) AS project_name", "concat('https://a/', id div 2 % 2) AS url", "'s' AS event_session_id",
            *(f"'' AS {name}" for name in ("stat_hour", "is_first_day", "distinct_id", "country", "province", "city", "manufacturer", "client_ip",
              "url_path", "title", "latest_referrer_host", "latest_search_keyword")),
        )
    ).cache()
    keys = ("project_name",)
    spans = visits(log, keys).drop("events")
    pages = log.select("event_session_id", "stat_date", "url").distinct()
    assert spans.count() == 2000 and span_ends(spans, pages, keys, PAGE).count() == 2 * 2000 * 2
    flow = page_flow(log, keys, PAGE)
    # Every span of 50,000 seconds holds the second half's hits until its end and the first half's after its start.
    rows = {(r["project_name"], r["url"]): r["down_pv_count"] for r in flow.collect()}
    assert rows["p0", "https://a/0"] == 1000 and rows["p0", "https://a/1"] == 1000
    assert rows["p1999", "https://a/1"] == 1000
    plan = plan_of(flow)
    assert not [line for line in plan.splitlines() if line.startswith("Join condition") and ("<=" in line or ">=" in line)]
