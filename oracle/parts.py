"""The building blocks as plain SQL."""

from __future__ import annotations

from oracle.reports import (
    URL_SITE,
    ACTIVE,
    DAYS,
    LIB,
    LOG,
    NEW_VIEW,
    PAGE,
    PAGE_EVENT,
    PROJECT,
    STD,
    VIEW,
    encoded,
    facts,
    grouping,
    listing,
    moment,
    sessions,
    shown,
    visitor_values,
    visit_cube,
)

DAY = "CAST(stat_date AS VARCHAR) AS stat_date"
KEYS = ["lib", "project_name", "is_first_day"]
SPAN = (
    f"{moment('started', 'started')}, {moment('ended', 'ended')},"
    " CAST(events AS BIGINT) AS events, CAST(seconds AS BIGINT) AS seconds"
)
PAGE_WITH_URL = f"{PAGE_EVENT} AND url <> ''"


def count_if(rule: str, name: str) -> str:
    return f"CAST(count(*) FILTER ({rule}) AS BIGINT) AS {name}"


def part_sql() -> dict[str, str]:
    raw = [dim.name for dim in STD] + ["distinct_id"]
    keys = ", ".join(raw)
    return {
        "event_classes": (
            f"WITH {LOG} SELECT {DAY}, lib, event, count(*) AS events, {count_if(VIEW, 'page_views')},"
            f" {count_if(NEW_VIEW, 'new_page_views')}, {count_if(ACTIVE, 'activities')},"
            f" {count_if(PAGE_EVENT, 'page_events')} FROM log GROUP BY ALL"
        ),
        "dimension_values": (
            f"WITH {LOG} SELECT CASE WHEN country IN ('', 'N/A') THEN '未知国家' ELSE country END AS country,"
            " CASE WHEN province IN ('', 'N/A') THEN '未知省份' ELSE province END AS province,"
            " CASE WHEN latest_referrer_host IN ('', 'N/A', 'url的domain解析失败') THEN '直接访问'"
            " ELSE latest_referrer_host END AS latest_referrer_host,"
            " CASE WHEN latest_search_keyword = 'N/A' THEN '' ELSE latest_search_keyword END AS latest_search_keyword,"
            " count(*) AS events FROM log WHERE latest_referrer_host <> '取值异常' AND latest_search_keyword NOT IN"
            " ('取值异常', '未取到值_直接打开', '未取到值', 'url的domain解析失败', '') GROUP BY ALL"
        ),
        "session_visits": (
            f"WITH {LOG}, {DAYS}, {sessions(KEYS, source='log')}"
            f" SELECT {DAY}, event_session_id, {', '.join(KEYS)}, {SPAN} FROM s"
        ),
        "session_hours": (
            f"WITH {LOG}, s AS (SELECT stat_date, stat_hour, event_session_id, {', '.join(KEYS)},"
            " min(log_time) AS started, max(log_time) AS ended, count(*) AS events,"
            " date_diff('second', min(log_time), max(log_time)) AS seconds FROM log WHERE event_session_id <> ''"
            f" GROUP BY ALL) SELECT {DAY}, stat_hour, event_session_id, {', '.join(KEYS)}, {SPAN} FROM s"
        ),
        "visit_totals": (
            f"WITH {LOG}, {DAYS}, {sessions(['lib', 'project_name'], source='log')}, {visit_cube((LIB, PROJECT))}"
            f" SELECT CAST(CASE WHEN gid & 2 <> 0 THEN 1 ELSE 0 END + CASE WHEN gid & 1 <> 0 THEN 2 ELSE 0 END AS INT)"
            f" AS rolled_bits, {DAY}, lib, project_name, CAST(visit_count AS BIGINT) AS visit_count,"
            " CAST(visit_time AS BIGINT) AS visit_time, CAST(bounce AS BIGINT) AS bounce FROM v"
        ),
        "distinct_totals": (
            f"WITH {LOG}, {encoded((LIB, PROJECT))}, {facts((LIB, PROJECT))}"
            f" SELECT {DAY}, {shown((LIB, PROJECT), 'f')}, pv, uv, new_uv, ip_count FROM f"
        ),
        "page_totals": (
            f"WITH {LOG}, {encoded((LIB, PAGE))}, c AS (SELECT stat_date, lib, page, {grouping((LIB, PAGE))} AS gid,"
            f" count(*) AS events FROM enc GROUP BY stat_date, CUBE ({listing((LIB, PAGE))}))"
            f" SELECT {DAY}, {shown((LIB, PAGE), 'c')}, events FROM c"
        ),
        "visitor_values": (
            f"WITH {LOG}, {DAYS}, {visitor_values('count(DISTINCT event_session_id)')},"
            f" t AS (SELECT stat_date, {keys}, sum(seconds) AS n FROM s GROUP BY stat_date, {keys}),"
            f" p AS (SELECT stat_date, {keys}, count(*) FILTER ({VIEW}) AS n FROM log GROUP BY stat_date, {keys})"
            f" SELECT CAST(p.stat_date AS VARCHAR) AS stat_date, {', '.join('p.' + k for k in raw)},"
            " CAST(p.n AS BIGINT) AS page_views, CAST(u.n AS BIGINT) AS visits, CAST(t.n AS BIGINT) AS seconds"
            f" FROM p LEFT JOIN u USING (stat_date, {keys}) LEFT JOIN t USING (stat_date, {keys})"
        ),
        "lifecycle_stages": (
            f"WITH {LOG}, days AS (SELECT CAST(unnest(generate_series(min(stat_date), max(stat_date),"
            " INTERVAL 1 DAY)) AS DATE) AS d FROM log),"
            " a AS (SELECT d, lib, distinct_id, bool_or(stat_date = d AND is_first_day = 'true') AS fresh,"
            " bool_or(stat_date = d) AS today, bool_or(stat_date = d - 1) AS yesterday FROM days JOIN log"
            f" ON stat_date >= d - 3 AND stat_date <= d WHERE {ACTIVE} GROUP BY ALL)"
            " SELECT CAST(d AS VARCHAR) AS stat_date, lib, distinct_id, CAST(fresh AS BIGINT) AS new_users,"
            " CAST(today AND yesterday AS BIGINT) AS continuous_active_users,"
            " CAST(today AND NOT yesterday AS BIGINT) AS revisit_users,"
            " CAST(NOT today AND yesterday AS BIGINT) AS silent_users,"
            " CAST(NOT today AND NOT yesterday AS BIGINT) AS churn_users FROM a"
        ),
        "session_pages": (
            f"WITH {LOG}, {DAYS}, {sessions(['lib'], PAGE_WITH_URL, 'b', 'log')},"
            f" {encoded((PAGE,))} SELECT CAST(b.stat_date AS VARCHAR) AS stat_date, b.lib, h.page.url AS url,"
            " h.page.url_path AS url_path, h.page.title AS title,"
            f" {count_if('h.log_time = b.started', 'entry_count')}, {count_if('h.log_time = b.ended', 'exit_count')},"
            f" {count_if('h.log_time > b.started AND h.log_time <= b.ended', 'down_pv_count')}"
            " FROM b JOIN enc h ON h.stat_date = b.stat_date AND h.event_session_id = b.event_session_id"
            f" WHERE h.{PAGE_EVENT} AND h.url <> '' AND h.log_time BETWEEN b.started AND b.ended"
            " GROUP BY b.stat_date, b.lib, h.page"
        ),
        "page_hosts": f"WITH {LOG} SELECT url, {URL_SITE} AS uri_host, count(*) AS events FROM log GROUP BY url",
        "report_days": (
            f"WITH {LOG}, {DAYS} SELECT CAST(d AS VARCHAR) AS stat_date, strftime(d, '%Y-%m-%d') AS day_text,"
            " CAST(d - 7 AS VARCHAR) AS visits_from, CAST(d - 3 AS VARCHAR) AS lifecycle_from,"
            " CAST(d + 1 AS VARCHAR) AS next_day FROM days"
        ),
        "earliest_days": (
            f"WITH {LOG} SELECT CAST(min(stat_date) FILTER (stat_date >= DATE '2023-01-01') AS VARCHAR) AS reports_from,"
            " CAST(min(stat_date) FILTER (stat_date >= DATE '2023-10-01') AS VARCHAR) AS page_report_from FROM log"
        ),
    }
