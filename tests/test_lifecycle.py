"""Activity bits against looking at every visitor and day."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from footfall.operators.lifecycle import STAGES, active_rows, activity_bits, visitor_stages
from footfall.sources.log import event_log
from tests.logs import day, event, log_of, random_events


def brute_force(events, end):
    active = {}
    for e in events:
        if (e["lib"] == "js" and e["event"] == "$pageview") or (e["lib"] in ("iOS", "Android", "MiniProgram") and e["event"] in ("$AppViewScreen", "$MPViewScreen")):
            at = (e["lib"], e["distinct_id"], e["stat_date"])
            active[at] = active.get(at, False) or e["is_first_day"] == "true"
    found = set()
    for lib, who, of in active:
        for ago in range(4):
            on = of + timedelta(days=ago)
            if on > end:
                continue
            today, yesterday = (lib, who, on) in active, (lib, who, on - timedelta(days=1)) in active
            new = today and active[lib, who, on]
            found.add((on, lib, who, int(new), int(today and yesterday), int(today and not yesterday), int(yesterday and not today), int(not today and not yesterday)))
    return Counter(found)


def test_stages_against_brute_force_across_many_blocks_of_days(spark):
    events = random_events(seed=31, rows=300, days=110)
    events += [event(n, distinct_id="often", is_first_day="true" if n % 5 == 0 else "false") for n in range(20, 70)]
    log = event_log(log_of(spark, *events)).cache()
    end = day(110)
    rows = visitor_stages(active_rows(log, None, None), ("lib",), None, F.lit(end))
    assert Counter(tuple(r) for r in rows.select("stat_date", "lib", "distinct_id", *STAGES).collect()) == brute_force(events, end)
    part = visitor_stages(active_rows(log, day(40), day(44)), ("lib",), day(40), F.lit(day(44)))
    wanted = Counter({row: n for row, n in brute_force(events, day(44)).items() if row[0] >= day(40)})
    assert Counter(tuple(r) for r in part.select("stat_date", "lib", "distinct_id", *STAGES).collect()) == wanted


def test_a_visitor_is_one_row_a_block_and_shuffled_once(spark):
    log = event_log(log_of(spark, *(event(n, f"1{m}:00:00", distinct_id="u") for n in range(1, 31) for m in range(5))))
    bits = activity_bits(active_rows(log, None, None), ("lib",))
    assert bits.count() <= 3
    plan = visitor_stages(active_rows(log, None, None), ("lib",), None, F.lit(day(31)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
