"""The cube against a plain count over every grouping set, and rules every report keeps."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall import report
from footfall.functions.buckets import PAGE_VIEWS, VISIT_SECONDS, VISITS, bucket_of
from footfall.functions.fields import Field, axis
from footfall.operators.cube import ROLLED, Cube
from tests.logs import log_of, random_events

AXES = tuple(axis(Field(name)) for name in ("a", "b", "c"))
DETAIL = axis(Field("d"), Field("e"))
COLUMNS = ("a", "b", "c", "d", "e")


def brute_force(rows):
    """Distinct visitors and sum per group, by going through all 2^4 grouping sets."""
    groups = {}
    for day, a, b, c, d, e, who, flag, n in rows:
        for ka, kb, kc, kd in product((True, False), repeat=4):
            values = (a if ka else None, b if kb else None, c if kc else None, d if kd else None, e if kd else None)
            mask = sum(bit for bit, kept in ((1, ka), (2, kb), (4, kc), (8, kd)) if not kept)
            seen, total = groups.setdefault((day, mask, *values), (set(), [0]))
            total[0] += n
            if flag:
                seen.add(who)
    return {key: (len(seen), total[0]) for key, (seen, total) in groups.items()}


small = st.sampled_from(["x", "y", ""])
row = st.tuples(
    st.integers(1, 2), small, small, small, small, small, st.sampled_from("pqr"), st.integers(0, 1), st.integers(0, 3)
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_distinct_cube_equals_counting_every_grouping_set(spark, rows):
    table = spark.createDataFrame(rows, "day int, a string, b string, c string, d string, e string, who string, f int, n int")
    cube = Cube(("day",), AXES, DETAIL)
    cells = cube.distinct_cells(cube.leaves(table, ("who", "f", "n")), ("who",), flags=("f",), sums=("n",))
    found = cube.totals(cells, ("f", "n")).select("day", ROLLED, *COLUMNS, "f", "n").collect()
    assert {tuple(one)[:7]: tuple(one)[7:] for one in found} == brute_force(rows)
    assert len(found) == len(brute_force(rows))


def test_an_axis_of_several_columns_agrees_only_where_all_of_them_do(spark):
    """Tuples that agree in one column of a plain axis and differ in the other are one visitor when it is rolled up."""
    rows = [(1, "x", "d1", "e1", "p", 1, 1), (1, "x", "d1", "e2", "p", 1, 1), (1, "x", "d2", "e2", "q", 1, 1), (1, "y", "d1", "e1", "q", 1, 1)]
    table = spark.createDataFrame(rows, "day int, a string, d string, e string, who string, f int, n int")
    cube = Cube(("day",), (axis(Field("a")), DETAIL))
    found = cube.totals(cube.distinct_cells(cube.leaves(table, ("who", "f", "n")), ("who",), ("f",), ("n",)), ("f", "n")).collect()
    counted = {(row["a"], row["d"], row["e"]): (row["f"], row["n"]) for row in found}
    assert counted == {
        ("x", "d1", "e1"): (1, 1), ("x", "d1", "e2"): (1, 1), ("x", "d2", "e2"): (1, 1), ("y", "d1", "e1"): (1, 1),
        ("x", None, None): (2, 3), ("y", None, None): (1, 1), (None, "d1", "e1"): (2, 2), (None, "d1", "e2"): (1, 1),
        (None, "d2", "e2"): (1, 1), (None, None, None): (2, 4),
    }


def test_a_visitor_with_very_many_tuples_does_not_meet_in_one_task(spark):
    hot = spark.range(66_590).selectExpr(
        "1 AS day", "concat('a', id % 10) AS a", "concat('b', id div 10 % 83) AS b", "concat('c', id div 830) AS c", "'everyone' AS who"
    )
    others = spark.range(5_000).selectExpr("1 AS day", "'a1' AS a", "'b1' AS b", "concat('c', id % 5) AS c", "concat('v', id) AS who")
    table = hot.unionByName(others).selectExpr("*", "1 AS f", "1 AS n").repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        cube = Cube(("day",), AXES)
        leaves = cube.leaves(table, ("who", "f", "n")).groupBy("day", ROLLED, "a", "b", "c", "who").agg(F.max("f").alias("f"), F.sum("n").alias("n"))
        described = cube._with_open(leaves, ("day", "who"), ("f", "n"))
        whole = described.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.xxhash64(*described.columns)))
        tasks = [row["n"] for row in whole.collect()]
        assert sum(tasks) == 71_590 and max(tasks) < 71_590 / 4, tasks
        totals = cube.totals(cube.distinct_cells(leaves, ("who",), ("f",), ("n",)), ("f", "n"))
        top = totals.filter("a IS NULL AND b IS NULL AND c IS NULL").first()
        assert (top["f"], top["n"]) == (5_001, 71_590)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_two_details_equal_counting_every_grouping_set(spark):
    """Sums over a cube with two detail axes, one with the value of a hot group, one with nulls in a plain axis."""
    chance = random.Random(5)
    rows = [
        (chance.randint(1, 2), chance.choice(["x", "y", None]), chance.choice("xy"), "c", chance.choice(["hot", "hot", "d1", "d2", "d3"]), chance.choice("ef"), chance.randint(0, 3))
        for _ in range(60)
    ]
    table = spark.createDataFrame(rows, "day int, a string, b string, c string, d string, e string, n int")
    cube = Cube(("day",), AXES, axis(Field("d")), axis(Field("e")))
    found = cube.totals(cube.open_cells(table, ("n",)), ("n",)).select("day", ROLLED, *COLUMNS, "n").collect()
    wanted = Counter()
    for day, *values, n in rows:
        for mask in range(1 << 5):
            wanted[day, mask, *(None if mask >> bit & 1 else value for bit, value in enumerate(values))] += n
    assert {tuple(one)[:-1]: one["n"] for one in found} == dict(wanted) and len(found) == len(wanted)


def copies_and_shuffles(frame) -> list[str]:
    """From the result down, what makes copies, adds up, compares or shuffles."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()[1:]]
    kept = ("Exchange", "Generate", "HashAggregate", "Window", "Union", "Join")
    return [line for line in lines if line.split("(")[0].split()[0] in kept] if lines else []


@pytest.mark.parametrize("name", ["visituri_detail_bydate", "visituri_summary_bydate", "sourcesite_summary_bydate"])
def test_copies_per_grouping_set_are_not_shuffled_within_a_detail(spark, name):
    lines = copies_and_shuffles(report(name, log_of(spark, *random_events(seed=1, rows=5))))
    words = [line.split("(")[0].split()[0] for line in lines]
    dealt = words.index("Exchange")
    assert words[:dealt] == ["Generate", "HashAggregate", "HashAggregate", "Generate", "Window"]
    assert "REPARTITION_BY_NUM" in lines[dealt] and "lib" not in lines[dealt]


def test_no_step_makes_many_copies_of_page_views(spark):
    """At most one copy per set of the two page axes (4) before a shuffle; it was one per set of all four axes (16)."""
    lines = copies_and_shuffles(report("visituri_summary_bydate", log_of(spark, *random_events(seed=1, rows=5))))
    shuffled = lines[[line.startswith("Exchange") for line in lines].index(True) :]
    made = [line for line in shuffled if line.startswith("Generate")]
    assert len(made) == 1 and re.search(r"explode\(\[0,\s*4,\s*8,\s*12\]\)", made[0]), made


def test_an_entity_on_a_page_is_counted_once_whatever_shares_the_page(spark):
    """Cells that agree on an axis are copied for it last: one page with one tuple, one with visitors apart on each axis."""
    rows = [(1, "x", "x", "x", "one", "e", "p", 1, 1), (1, "x", "x", "x", "one", "e", "q", 1, 1)]
    rows += [(1, a, b, "x", "two", "e", who, 1, 1) for who, a, b in (("p", "x", "x"), ("p", "y", "x"), ("q", "x", "y"))]
    table = spark.createDataFrame(rows, "day int, a string, b string, c string, d string, e string, who string, f int, n int")
    cube = Cube(("day",), AXES, DETAIL)
    cells = cube.distinct_cells(cube.leaves(table, ("who", "f", "n")), ("who",), flags=("f",), sums=("n",))
    found = cube.totals(cells, ("f", "n")).select("day", ROLLED, *COLUMNS, "f", "n").collect()
    assert {tuple(one)[:7]: tuple(one)[7:] for one in found} == brute_force(rows) and len(found) == len(brute_force(rows))


@pytest.mark.parametrize("buckets", [PAGE_VIEWS, VISITS, VISIT_SECONDS])
def test_buckets_begin_at_their_least_value(spark, buckets):
    values = spark.range(4000).selectExpr("id", f"{bucket_of('id', buckets)} AS bucket").collect()
    for value, bucket in ((one.id, one.bucket) for one in values):
        fitting = [name for name, least in buckets.items() if least <= value]
        assert bucket == (fitting[-1] if fitting else None)


def test_measures_of_a_traffic_report_bound_each_other(spark):
    log = log_of(spark, *random_events(seed=3, rows=300)).cache()
    rows = report("area_detail_bydate", log).cache()
    assert rows.filter("uv > pv OR new_uv > uv OR bounce > visit_count OR ip_count < 1 OR visit_time < 0").count() == 0
    views = {one.stat_date: one.pv for one in rows.filter("lib = 'all' AND project_name = 'all' AND is_first_day = 'all'"
             " AND country = 'all' AND province = 'all' AND city = 'all'").collect()}  # fmt: skip
    full = rows.filter("lib <> 'all' AND project_name <> 'all' AND is_first_day <> 'all'"
                       " AND country <> 'all' AND province <> 'all' AND city <> 'all'")  # fmt: skip
    assert {one["stat_date"]: one["sum(pv)"] for one in full.groupBy("stat_date").sum("pv").collect()} == views
