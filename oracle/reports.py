"""One SQL text per report for DuckDB.

Written the plain way, unlike the Spark jobs: every day joined to its own eight days of log, the
first day taken per group, CUBE with count(DISTINCT), facts and visits cubed apart and joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from footfall.sources.sample import BLANK_LOG_SQL, DUCKDB_JOIN, LOG_SQL

VIEW = (
    "((lib = 'js' AND event = '$pageview') OR (lib IN ('iOS', 'Android') AND event = '$AppViewScreen')"
    " OR (lib = 'MiniProgram' AND event = '$MPViewScreen'))"
)
NEW_VIEW = f"({VIEW} AND is_first_day = 'true')"
ACTIVE = (
    "((lib = 'js' AND event = '$pageview') OR"
    " (lib IN ('iOS', 'Android', 'MiniProgram') AND event IN ('$AppViewScreen', '$MPViewScreen')))"
)
PAGE_EVENT = "event IN ('$pageview', '$AppViewScreen', '$MPViewScreen')"
NO_WORD = "('取值异常', '未取到值_直接打开', '未取到值', 'url的domain解析失败', '')"


def unknown(column: str) -> str:
    return f"CASE WHEN {column} = '' THEN 'N/A' ELSE {column} END"


@dataclass(frozen=True)
class Dim:
    """Output name, grouping expression over the log, and what N/A reads as (None: as it is)."""

    name: str
    value: str | None = None
    label: str | None = ""

    def encode(self) -> str:
        return f"{self.value or self.name} AS {self.name}"


LIB = Dim("lib", label=None)
PROJECT = Dim("project_name")
FIRST = Dim("is_first_day", label=None)
COUNTRY = Dim("country", unknown("country"))
PROVINCE = Dim("province", unknown("province"))
NAMED_COUNTRY = Dim("country", unknown("country"), "未知国家")
NAMED_PROVINCE = Dim("province", unknown("province"), "未知省份")
STD = (LIB, PROJECT, FIRST, COUNTRY, PROVINCE)
STD_NAMED = (LIB, PROJECT, FIRST, NAMED_COUNTRY, NAMED_PROVINCE)
NAMED_CITY = Dim("city", unknown("city"), "未知城市")
MAKER = Dim("manufacturer", unknown("manufacturer"))
WORD = Dim("latest_search_keyword")
REFERRER = Dim(
    "latest_referrer_host",
    "CASE WHEN latest_referrer_host IN ('', 'url的domain解析失败') THEN 'N/A' ELSE latest_referrer_host END",
    "直接访问",
)
PAGE = Dim(
    "page",
    "struct_pack(url := CASE WHEN url IN ('', 'url的domain解析失败') THEN 'N/A' ELSE url END,"
    f" url_path := {unknown('url_path')}, title := {unknown('title')})",
)

LOG = "log AS (" + LOG_SQL.replace("{joined}", DUCKDB_JOIN) + ")"
BLANK_LOG = "log AS (" + BLANK_LOG_SQL.replace("{joined}", DUCKDB_JOIN) + ")"


def on_blank_log(sql: str) -> str:
    return sql.replace(LOG, BLANK_LOG)


def on_last_day(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE stat_date = (SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events)"


# Cut step by step: what stands before the path, without user info and port, if it holds a dot.
_AUTHORITY = "regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://', ''), '^[^/?#]*')"
_HOST = f"split_part(split_part({_AUTHORITY}, '@', -1), ':', 1)"
URL_SITE = (
    "CASE WHEN NOT starts_with(url, 'http') THEN '' ELSE"
    " concat(CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN split_part(url, ':', 1) ELSE '' END,"
    f" '://', CASE WHEN {_HOST} LIKE '%._%' THEN {_HOST} ELSE '' END) END"
)
DAYS = "days AS (SELECT DISTINCT stat_date AS d FROM log)"


def listing(dims: Sequence[Dim], prefix: str = "") -> str:
    return ", ".join(prefix + dim.name for dim in dims)


def encoded(dims: Sequence[Dim], where: str = "true", source: str = "log") -> str:
    """CTE `enc`: log with grouping values; the other columns as they are."""
    names = ", ".join(dim.name for dim in dims if dim.value and dim is not PAGE)
    kept = f"* EXCLUDE ({names})" if names else "*"
    values = "".join(f", {dim.encode()}" for dim in dims if dim.value)
    return f"enc AS (SELECT {kept}{values} FROM {source} WHERE {where})"


def grouping(dims: Sequence[Dim]) -> str:
    return f"CAST(GROUPING_ID({listing(dims)}) AS BIGINT)"


def same(dims: Sequence[Dim], left: str, right: str, keys: Sequence[str] = ("stat_date",)) -> str:
    equal = [f"{left}.{key} = {right}.{key}" for key in (*keys, "gid")]
    return " AND ".join(equal + [f"{left}.{d.name} IS NOT DISTINCT FROM {right}.{d.name}" for d in dims])


def shown(dims: Sequence[Dim], table: str) -> str:
    """The dimension columns as they read in the report."""
    parts = []
    for position, dim in enumerate(dims):
        bit = 1 << (len(dims) - 1 - position)
        rolled = f"({table}.gid & {bit}) <> 0"
        if dim is PAGE:
            parts += [
                f"CASE WHEN {rolled} THEN 'all' ELSE {table}.page.{part} END AS {part}"
                for part in ("url", "url_path", "title")
            ]
            continue
        column = f"{table}.{dim.name}"
        value = column if dim.label is None else f"CASE WHEN {column} = 'N/A' THEN '{dim.label}' ELSE {column} END"
        parts.append(f"CASE WHEN {rolled} THEN 'all' ELSE {value} END AS {dim.name}")
    return ", ".join(parts)


DATE = "CAST({t}.stat_date AS VARCHAR) AS stat_date"


def facts(dims: Sequence[Dim], hour: bool = False) -> str:
    keys = "stat_date, stat_hour" if hour else "stat_date"
    return (
        f"f AS (SELECT {keys}, {listing(dims)}, {grouping(dims)} AS gid,"
        f" count(*) FILTER ({VIEW}) AS pv,"
        f" count(DISTINCT CASE WHEN {VIEW} THEN distinct_id END) AS uv,"
        f" count(DISTINCT CASE WHEN {NEW_VIEW} THEN distinct_id END) AS new_uv,"
        f" count(DISTINCT client_ip) AS ip_count"
        f" FROM enc GROUP BY {keys}, CUBE ({listing(dims)}))"
    )


def sessions(columns: Sequence[str], where: str = "true", name: str = "s", source: str = "enc") -> str:
    """CTE: sessions per day that begin on it, each day looking at its own eight days of log."""
    keys = ", ".join(columns)
    return (
        f"{name} AS (SELECT d AS stat_date, event_session_id, {keys},"
        f" min(log_time) AS started, max(log_time) AS ended, count(*) AS events,"
        f" date_diff('second', min(log_time), max(log_time)) AS seconds"
        f" FROM days JOIN {source} ON stat_date <= d AND stat_date >= d - 7"
        f" WHERE event_session_id <> '' AND {where}"
        f" GROUP BY d, event_session_id, {keys} HAVING min(stat_date) = d)"
    )


def visit_cube(dims: Sequence[Dim], hour: bool = False) -> str:
    keys = "stat_date, stat_hour" if hour else "stat_date"
    return (
        f"v AS (SELECT {keys}, {listing(dims)}, {grouping(dims)} AS gid, count(*) AS visit_count,"
        f" sum(seconds) AS visit_time, count(*) FILTER (events = 1) AS bounce"
        f" FROM s GROUP BY {keys}, CUBE ({listing(dims)}))"
    )


def big(name: str, table: str) -> str:
    return f"CAST(coalesce({table}.{name}, 0) AS BIGINT) AS {name}"


def numbers(new: bool) -> str:
    first = [big("pv", "f"), big("visit_count", "v"), big("uv", "f")]
    middle = [big("new_uv", "f")] if new else []
    return ", ".join([*first, *middle, big("ip_count", "f"), big("visit_time", "v"), big("bounce", "v")])


def traffic(dims: Sequence[Dim], new: bool = True, where: str = "true", hours: str | None = None) -> str:
    keys = ("stat_date", "stat_hour") if hours else ("stat_date",)
    columns = [*keys[1:], *(dim.name for dim in dims)]
    if hours == "within":
        begun = (
            f"s AS (SELECT stat_date, event_session_id, {', '.join(columns)}, count(*) AS events,"
            " date_diff('second', min(log_time), max(log_time)) AS seconds FROM enc"
            f" WHERE event_session_id <> '' GROUP BY stat_date, event_session_id, {', '.join(columns)})"
        )
    else:
        begun = sessions(columns)
    hour = "f.stat_hour, " if hours else ""
    return (
        f"WITH {LOG}, {DAYS}, {encoded(dims, where)}, {facts(dims, bool(hours))}, {begun},"
        f" {visit_cube(dims, bool(hours))}"
        f" SELECT {DATE.format(t='f')}, {hour}{shown(dims, 'f')}, {numbers(new)}"
        f" FROM f LEFT JOIN v ON {same(dims, 'f', 'v', keys)}"
    )


def page_views(dims: Sequence[Dim], where: str = "true") -> str:
    return (
        f"WITH {LOG}, {encoded(dims)}, f AS (SELECT stat_date, {listing(dims)}, {grouping(dims)} AS gid,"
        f" count(*) FILTER ({VIEW}) AS pv FROM enc WHERE {where} GROUP BY stat_date, CUBE ({listing(dims)}))"
        f" SELECT {DATE.format(t='f')}, {shown(dims, 'f')}, {big('pv', 'f')} FROM f"
    )


def page_report() -> str:
    dims = (*STD, PAGE)
    base = listing(STD)
    hosts = f"{URL_SITE} AS uri_host"
    events = f"{PAGE_EVENT} AND url <> ''"
    flow = (
        f"e AS (SELECT b.stat_date, {listing(STD, 'b.')}, h.page,"
        f" CAST(GROUPING_ID({listing(STD, 'b.')}, h.page) AS BIGINT) AS gid,"
        " count(*) FILTER (h.log_time = b.started) AS entry_count,"
        " count(*) FILTER (h.log_time = b.ended) AS exit_count,"
        " count(*) FILTER (h.log_time > b.started AND h.log_time <= b.ended) AS down_pv_count"
        " FROM b JOIN enc h ON h.stat_date = b.stat_date AND h.event_session_id = b.event_session_id"
        f" WHERE h.{PAGE_EVENT} AND h.url <> ''"
        f" GROUP BY b.stat_date, CUBE ({listing(STD, 'b.')}, h.page))"
    )
    return (
        f"WITH {LOG}, {DAYS}, {encoded(dims)}, {facts(dims)}, {sessions([d.name for d in dims])},"
        f" {visit_cube(dims)}, {sessions([d.name for d in STD], events, name='b')}, {flow},"
        f" r AS (SELECT {DATE.format(t='f')}, {shown(dims, 'f')}, {numbers(True)},"
        f" {big('entry_count', 'e')}, {big('exit_count', 'e')}, {big('down_pv_count', 'e')}"
        f" FROM f LEFT JOIN v ON {same(dims, 'f', 'v')} LEFT JOIN e ON {same(dims, 'f', 'e')})"
        f" SELECT *, {hosts} FROM r"
    )


def ranges(value: str, starts: Sequence[tuple[str, int]]) -> str:
    """One distinct count of visitors per range, from its least value to the next one's."""
    parts = []
    for position, (name, least) in enumerate(starts):
        inside = f"{value} >= {least}"
        if position + 1 < len(starts):
            inside += f" AND {value} < {starts[position + 1][1]}"
        parts.append(f"CAST(count(DISTINCT CASE WHEN {inside} THEN distinct_id END) AS BIGINT) AS {name}")
    return ", ".join(parts)


PV_RANGES = [
    ("pv0_uv", 0), ("pv1_uv", 1), ("pv2_5_uv", 2), ("pv6_10_uv", 6), ("pv11_20_uv", 11),
    ("pv21_30_uv", 21), ("pv31_40_uv", 31), ("pv41_50_uv", 41), ("pv51_100_uv", 51), ("pv101_uv", 101),
]
VISIT_RANGES = [
    *((f"v{n}_uv", n) for n in range(1, 11)),
    ("v11_15_uv", 11), ("v16_50_uv", 16), ("v51_100_uv", 51), ("v101_200_uv", 101), ("v201_300_uv", 201),
    ("vt301_uv", 301),
]
TIME_RANGES = [
    ("vt0_10_uv", 0), ("vt10_30_uv", 10), ("vt30_60_uv", 30), ("vt60_120_uv", 60), ("vt120_180_uv", 120),
    ("vt180_240_uv", 180), ("vt240_300_uv", 240), ("vt300_600_uv", 300), ("vt600_1800_uv", 600),
    ("vt1800_3600_uv", 1800), ("vt3600_uv", 3600),
]


def histogram(per_visitor: str, starts: Sequence[tuple[str, int]]) -> str:
    counted = ", ".join(name for name, _ in starts)
    return (
        f"WITH {LOG}, {DAYS}, {per_visitor}, {encoded(STD, source='u')},"
        f" c AS (SELECT stat_date, {listing(STD)}, {grouping(STD)} AS gid, {ranges('n', starts)}"
        f" FROM enc GROUP BY stat_date, CUBE ({listing(STD)}))"
        f" SELECT {DATE.format(t='c')}, {shown(STD, 'c')}, {counted} FROM c"
    )


def visitor_values(value: str) -> str:
    raw = [dim.name for dim in STD] + ["distinct_id"]
    keys = ", ".join(raw)
    return f"{sessions(raw, source='log')}, u AS (SELECT stat_date, {keys}, {value} AS n FROM s GROUP BY stat_date, {keys})"


def user_pv() -> str:
    keys = listing(STD) + ", distinct_id"
    return histogram(
        f"u AS (SELECT stat_date, {keys}, count(*) FILTER ({VIEW}) AS n FROM log GROUP BY stat_date, {keys})", PV_RANGES
    )


def lifecycle() -> str:
    dims = (Dim("lib", unknown("lib"), None), Dim("project_name", unknown("project_name")), COUNTRY, PROVINCE)
    raw = "lib, project_name, country, province"
    stages = {
        "new_users": "fresh AND today",
        "continuous_active_users": "today AND yesterday",
        "revisit_users": "today AND NOT yesterday",
        "silent_users": "NOT today AND yesterday",
        "churn_users": "NOT today AND NOT yesterday AND (before2 OR before3)",
    }
    counts = ", ".join(
        f"CAST(count(DISTINCT CASE WHEN {rule} THEN distinct_id END) AS BIGINT) AS {name}"
        for name, rule in stages.items()
    )
    return (
        f"WITH {LOG}, days AS (SELECT CAST(unnest(generate_series(min(stat_date), max(stat_date), INTERVAL 1 DAY))"
        " AS DATE) AS d FROM log),"
        f" a AS (SELECT d AS stat_date, {raw}, distinct_id,"
        " bool_or(stat_date = d AND is_first_day = 'true') AS fresh, bool_or(stat_date = d) AS today,"
        " bool_or(stat_date = d - 1) AS yesterday, bool_or(stat_date = d - 2) AS before2,"
        " bool_or(stat_date = d - 3) AS before3"
        f" FROM days JOIN log ON stat_date >= d - 3 AND stat_date <= d WHERE {ACTIVE}"
        f" GROUP BY d, {raw}, distinct_id), {encoded(dims, source='a')},"
        f" c AS (SELECT stat_date, {listing(dims)}, {grouping(dims)} AS gid, {counts}"
        f" FROM enc GROUP BY stat_date, CUBE ({listing(dims)}))"
        f" SELECT {DATE.format(t='c')}, {shown(dims, 'c')}, {', '.join(stages)} FROM c"
    )


def readable(dim: Dim, table: str) -> str:
    """Without a cube: '' reads 'all', N/A its label."""
    column = f"{table}.{dim.name}"
    if dim.label is None:
        return f"CASE WHEN {column} = '' THEN 'all' ELSE {column} END AS {dim.name}"
    return f"CASE {column} WHEN '' THEN 'all' WHEN 'N/A' THEN '{dim.label}' ELSE {column} END AS {dim.name}"


def moment(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


def by_visitor() -> str:
    dims = STD_NAMED
    keys = listing(dims) + ", distinct_id"
    match = " AND ".join(f"f.{k} = v.{k}" for k in ("stat_date", *(d.name for d in dims), "distinct_id"))
    return (
        f"WITH {LOG}, {DAYS}, {encoded(dims)},"
        f" f AS (SELECT stat_date, {keys}, count(*) FILTER ({VIEW}) AS pv,"
        f" count(DISTINCT CASE WHEN {VIEW} THEN distinct_id END) AS uv,"
        f" count(DISTINCT CASE WHEN {NEW_VIEW} THEN distinct_id END) AS new_uv,"
        " count(DISTINCT client_ip) AS ip_count, max(log_time) AS latest"
        f" FROM enc GROUP BY stat_date, {keys}), {sessions([*(d.name for d in dims), 'distinct_id'])},"
        f" v AS (SELECT stat_date, {keys}, count(*) AS visit_count, sum(seconds) AS visit_time,"
        f" count(*) FILTER (events = 1) AS bounce FROM s GROUP BY stat_date, {keys})"
        f" SELECT {DATE.format(t='f')}, {', '.join(readable(d, 'f') for d in dims)}, f.distinct_id, {numbers(True)},"
        f" {moment('f.latest', 'latest_time')} FROM f LEFT JOIN v ON {match} WHERE f.distinct_id <> ''"
    )


def by_info() -> str:
    dims = (
        LIB, Dim("project_name", label="未知"), FIRST, NAMED_COUNTRY, NAMED_PROVINCE, NAMED_CITY,
        Dim("client_ip", unknown("client_ip"), "未知"), Dim("manufacturer", unknown("manufacturer"), "未知"),
    )
    keys = listing(dims) + ", distinct_id"
    visit_names = [*(d.name for d in dims if d is not FIRST), "distinct_id"]
    visit_keys = ", ".join(visit_names)
    all_match = " AND ".join(f"t.{k} = p.{k}" for k in ("stat_date", *(d.name for d in dims), "distinct_id"))
    match = " AND ".join(f"t.{k} = v.{k}" for k in ("stat_date", *visit_names))
    return (
        f"WITH {LOG}, {DAYS}, {encoded(dims)},"
        f" t AS (SELECT stat_date, {keys}, min(log_time) AS earliest, max(log_time) AS latest FROM enc"
        f" WHERE distinct_id <> '' GROUP BY stat_date, {keys}),"
        f" p AS (SELECT stat_date, {keys}, count(*) FILTER ({VIEW}) AS pv FROM enc GROUP BY stat_date, {keys}),"
        f" {sessions(visit_names)}, v AS (SELECT stat_date, {visit_keys}, count(*) AS visit_count,"
        f" sum(seconds) AS visit_time FROM s GROUP BY stat_date, {visit_keys})"
        f" SELECT {DATE.format(t='t')}, {', '.join(readable(d, 't') for d in dims)}, t.distinct_id,"
        f" {moment('t.latest', 'latest_time')}, {moment('t.earliest', 'first_time')},"
        f" {big('visit_time', 'v')}, {big('visit_count', 'v')}, {big('pv', 'p')}"
        f" FROM t LEFT JOIN p ON {all_match} LEFT JOIN v ON {match}"
    )


def by_session() -> str:
    dims = (
        Dim("project_name", label="未知"), NAMED_COUNTRY, NAMED_PROVINCE,
        Dim("sourcesite", "CASE WHEN latest_referrer_host IN ('', 'url的domain解析失败') THEN 'N/A'"
            " ELSE latest_referrer_host END", "直接访问"),
        Dim("searchword", unknown("latest_search_keyword"), ""),
    )
    place = ["project_name", "country", "province", "client_ip", "distinct_id"]
    view_keys = ["stat_date", *place, "event_session_id"]
    match = " AND ".join(f"s.{k} = p.{k}" for k in view_keys)
    # Names that are new in `enc` cannot be excluded from the log.
    enc = (
        f"enc AS (SELECT * EXCLUDE (country, province), {', '.join(d.encode() for d in dims if d.value)} FROM log)"
    )
    return (
        f"WITH {LOG}, {DAYS}, {enc}, {sessions([*place, 'sourcesite', 'searchword'])},"
        f" p AS (SELECT {', '.join(view_keys)}, count(*) FILTER ({VIEW}) AS pv FROM enc"
        f" WHERE event_session_id <> '' GROUP BY {', '.join(view_keys)})"
        f" SELECT {DATE.format(t='s')}, {', '.join(readable(d, 's') for d in dims)},"
        " CASE WHEN s.client_ip = '' THEN 'N/A' ELSE s.client_ip END AS client_ip, s.distinct_id, s.event_session_id,"
        f" {moment('s.started', 'first_time')}, {moment('s.ended', 'latest_time')},"
        f" CAST(s.seconds AS BIGINT) AS visit_time, {big('pv', 'p')}"
        f" FROM s LEFT JOIN p ON {match}"
    )


def source_summary() -> str:
    site = "CASE WHEN latest_referrer_host = '' THEN 'N/A' ELSE latest_referrer_host END"
    dims = (LIB, PROJECT, Dim("sourcesite"))
    return (
        f"WITH {LOG}, enc AS (SELECT *, {site} AS sourcesite FROM log WHERE latest_referrer_host <> '取值异常'),"
        f" f AS (SELECT stat_date, {listing(dims)}, {grouping(dims)} AS gid, count(*) FILTER ({VIEW}) AS pv"
        f" FROM enc GROUP BY stat_date, CUBE ({listing(dims)}))"
        f" SELECT {DATE.format(t='f')}, {shown(dims, 'f')}, {big('pv', 'f')} FROM f"
    )


def report_sql() -> dict[str, str]:
    standard = traffic(STD)
    return {
        "flow_summary_bydate": traffic((LIB, PROJECT), new=False),
        "flow_summary_byhour": traffic((LIB, PROJECT), new=False, hours="within"),
        "flow_trend_bydate": standard,
        "flow_trend_byhour": traffic(STD, hours="look_back"),
        "visitor_summary_bydate": traffic((FIRST, LIB, PROJECT), new=False),
        "visitor_detail_bydate": standard,
        "channel_detail_bydate": standard,
        "area_detail_bydate": traffic((*STD_NAMED, NAMED_CITY)),
        "area_summary_bydate": page_views((LIB, PROJECT, NAMED_COUNTRY, NAMED_PROVINCE)),
        "device_detail_bydate": traffic((*STD, MAKER)),
        "searchword_detail_bydate": traffic((*STD, WORD), where=f"latest_search_keyword NOT IN {NO_WORD}"),
        "searchword_summary_bydate": page_views(
            (LIB, PROJECT, Dim("latest_search_keyword", unknown("latest_search_keyword"))),
            f"latest_search_keyword NOT IN {NO_WORD}",
        ),
        "sourcesite_detail_bydate": traffic((*STD, REFERRER), where="latest_referrer_host NOT IN ('取值异常')"),
        "sourcesite_summary_bydate": source_summary(),
        "visituri_detail_bydate": page_report(),
        "visituri_summary_bydate": page_views(
            (LIB, PROJECT, Dim("url", unknown("url")), Dim("title", unknown("title")))
        ),
        "user_pv_bydate": user_pv(),
        "user_visit_bydate": histogram(visitor_values("count(DISTINCT event_session_id)"), VISIT_RANGES),
        "user_visittime_bydate": histogram(visitor_values("sum(seconds)"), TIME_RANGES),
        "visitor_life_bydate": lifecycle(),
        "visitor_summary_byvisitor": by_visitor(),
        "visitor_detail_byinfo": by_info(),
        "visitor_detail_bysession": by_session(),
    }
