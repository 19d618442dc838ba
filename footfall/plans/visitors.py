"""Per-visitor and per-session reports: no cube, one row per identity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.events import IS_NEW_PAGE_VIEW, IS_PAGE_VIEW, literal
from footfall.functions.fields import Field, encode
from footfall.model import ALL, DIRECT_ACCESS, DOMAIN_PARSE_FAILED, NOT_AVAILABLE, UNKNOWN
from footfall.operators.visits import HAS_SESSION, SECONDS, SESSION, visit_measures, visits
from footfall.plans.dimensions import (
    FIRST_DAY,
    LIB,
    NAMED_CITY,
    NAMED_COUNTRY,
    NAMED_PROVINCE,
    PROJECT,
)
from footfall.sources.log import ENDED, EVENTS, RAW, STARTED, between_days

VISITOR = "distinct_id"
HAS_VISITOR = f"{RAW}{VISITOR} <> ''"


def _names(fields: Sequence[Field]) -> tuple[str, ...]:
    return tuple(field.name for field in fields)


def _labelled(fields: Sequence[Field]) -> list[str]:
    # Nothing is rolled up here, and an empty value reads as the total does.
    return [f"{field.labelled(blank=ALL)} AS {field.name}" for field in fields]


def _zero(name: str) -> str:
    return f"CAST(coalesce({name}, 0) AS BIGINT) AS {name}"


def _sum(rule: str) -> str:
    return f"coalesce(sum({EVENTS}) FILTER (WHERE {rule}), 0)"


BY_VISITOR = (LIB, PROJECT, FIRST_DAY, NAMED_COUNTRY, NAMED_PROVINCE)


def by_visitor(log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Facts and visits of each visitor per dimension tuple.

    Facts arrive one row per address and visits one row per visit; both are added up in a single
    grouping, so neither side is joined.
    """
    keys = ("stat_date", *_names(BY_VISITOR), VISITOR)
    rows = encode(log.filter(HAS_VISITOR), BY_VISITOR)
    addresses = (
        between_days(rows, first, last)
        .groupBy(*keys, "client_ip")
        .agg(
            F.expr(f"{_sum(IS_PAGE_VIEW)} AS pv"),
            F.expr(f"{_sum(IS_NEW_PAGE_VIEW)} AS new_pv"),
            F.max(ENDED).alias("latest_time"),
        )
        .selectExpr(*keys, "pv", "new_pv", "latest_time", "1 AS ip_count")
    )
    begun = visit_measures(visits(rows, keys[1:], first, last), keys)
    merged = (
        addresses.unionByName(begun, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.sum("pv").alias("pv"),
            F.sum("visit_count").alias("visit_count"),
            F.expr("CAST(sum(pv) > 0 AS INT) AS uv"),
            F.expr("CAST(sum(new_pv) > 0 AS INT) AS new_uv"),
            F.sum("ip_count").alias("ip_count"),
            F.sum("visit_time").alias("visit_time"),
            F.sum("bounce").alias("bounce"),
            F.max("latest_time").alias("latest_time"),
        )
    )
    metrics = ("pv", "visit_count", "uv", "new_uv", "ip_count", "visit_time", "bounce")
    return merged.selectExpr(
        "stat_date", *_labelled(BY_VISITOR), VISITOR, *(_zero(name) for name in metrics), "latest_time"
    )


BY_INFO_VISIT = (
    LIB,
    Field("project_name", label=UNKNOWN),
    NAMED_COUNTRY,
    NAMED_PROVINCE,
    NAMED_CITY,
    Field("client_ip", unknown=("",), label=UNKNOWN),
    Field("manufacturer", unknown=("",), label=UNKNOWN),
)


def by_info(log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Times, visits and page views of each visitor per place, address and device.

    Visits are not told apart by first day, so the rows of both first-day values show the same ones.
    """
    visit_keys = ("stat_date", *_names(BY_INFO_VISIT), VISITOR)
    rows = encode(log.filter(HAS_VISITOR), BY_INFO_VISIT)
    facts = (
        between_days(rows, first, last)
        .groupBy(*visit_keys, FIRST_DAY.name)
        .agg(
            F.max(ENDED).alias("latest_time"),
            F.min(STARTED).alias("first_time"),
            F.expr(f"{_sum(IS_PAGE_VIEW)} AS pv"),
        )
    )
    begun = (
        visit_measures(visits(rows, visit_keys[1:], first, last), visit_keys)
        .groupBy(*visit_keys)
        .agg(F.sum("visit_time").alias("visit_time"), F.sum("visit_count").alias("visit_count"))
    )
    joined = facts.join(begun, list(visit_keys), "left")
    return joined.selectExpr(
        "stat_date",
        *_labelled((*BY_INFO_VISIT, FIRST_DAY)),
        VISITOR,
        "latest_time",
        "first_time",
        _zero("visit_time"),
        _zero("visit_count"),
        _zero("pv"),
    )


BY_SESSION = (
    Field("project_name", label=UNKNOWN),
    NAMED_COUNTRY,
    NAMED_PROVINCE,
    Field("sourcesite", source="latest_referrer_host", unknown=("", DOMAIN_PARSE_FAILED), label=DIRECT_ACCESS),
    Field("searchword", source="latest_search_keyword", unknown=("",)),
)


def by_session(log: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Times and page views of each session begun on the day.

    Page views are not told apart by referrer and search word: a session with several of them
    shows its page views on each row.
    """
    place = ("project_name", "country", "province", "client_ip", VISITOR)
    view_keys = ("stat_date", *place, SESSION)
    rows = encode(log.filter(HAS_SESSION), BY_SESSION)
    begun = visits(rows, (*place, "sourcesite", "searchword"), first, last)
    views = between_days(rows, first, last).groupBy(*view_keys).agg(F.expr(f"{_sum(IS_PAGE_VIEW)} AS pv"))
    joined = begun.join(views, list(view_keys), "left")
    return joined.selectExpr(
        "stat_date",
        *_labelled(BY_SESSION),
        f"CASE WHEN client_ip = '' THEN {literal(NOT_AVAILABLE)} ELSE client_ip END AS client_ip",
        VISITOR,
        SESSION,
        "started AS first_time",
        "ended AS latest_time",
        f"{SECONDS} AS visit_time",
        _zero("pv"),
    )
