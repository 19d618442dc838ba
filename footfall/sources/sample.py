"""An event log derived from all rows of the tables `events` and `pages`, for tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING"
PAGES = "page_id BIGINT, url STRING"
# Both texts run unchanged on Spark and on DuckDB; `{joined}` is the join of events and pages.
PAGES_SQL = r"""
SELECT page_id, url
 , regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path
 , regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host
FROM {pages}
"""
LOG_SQL = r"""
SELECT CAST(e.ts AS DATE) AS stat_date
 , lpad(CAST(hour(e.ts) AS VARCHAR(2)), 2, '0') AS stat_hour
 , date_trunc('second', e.ts) AS log_time
 , CASE WHEN e.user_id % 5 < 2 THEN 'js' WHEN e.user_id % 5 = 2 THEN 'iOS'
        WHEN e.user_id % 5 = 3 THEN 'Android' ELSE 'MiniProgram' END AS lib
 , CASE WHEN e.event_type IN ('view', 'click') THEN
          CASE WHEN e.user_id % 5 < 2 THEN '$pageview'
               WHEN e.user_id % 5 < 4 THEN '$AppViewScreen' ELSE '$MPViewScreen' END
        WHEN e.event_type = 'purchase' THEN '$AppViewScreen'
        WHEN e.event_type = 'signup' THEN '$SignUp' ELSE '$WebClick' END AS event
 , CASE WHEN e.user_id % 7 < 5 THEN 'alpha' ELSE 'beta' END AS project_name
 , CASE WHEN e.event_id % 4 = 0 THEN 'true' ELSE 'false' END AS is_first_day
 , CASE WHEN e.event_id % 97 = 0 THEN '' ELSE concat('u', CAST(e.user_id AS VARCHAR(20))) END AS distinct_id
 , CASE WHEN e.event_id % 11 = 0 THEN ''
        WHEN e.event_id % 50 = 1 THEN concat('x', CAST(e.user_id % 40 AS VARCHAR(20)))
        ELSE concat('s', CAST(e.user_id AS VARCHAR(20)), '-',
             CAST(CAST(floor((24 * (dayofyear(e.ts) - 1) + hour(e.ts)) / 36.0) AS INT) AS VARCHAR(10)))
   END AS event_session_id
 , CASE e.user_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'China' WHEN 2 THEN 'China' ELSE 'Japan' END AS country
 , CASE e.user_id % 8 WHEN 1 THEN 'Zhejiang' WHEN 2 THEN 'Beijing' WHEN 3 THEN 'Tokyo' ELSE '' END AS province
 , CASE WHEN e.user_id % 3 = 0 THEN '' ELSE concat('city', CAST(e.user_id % 3 AS VARCHAR(2))) END AS city
 , CASE e.user_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'Apple' ELSE 'Huawei' END AS manufacturer
 , concat('10.0.', CAST(e.user_id % 16 AS VARCHAR(4)), '.', CAST(e.event_id % 3 AS VARCHAR(4))) AS client_ip
 , CASE WHEN e.event_id % 13 = 0 THEN '' WHEN e.event_id % 17 = 0 THEN 'url的domain解析失败' ELSE p.url END AS url
 , CASE WHEN e.event_id % 13 = 0 THEN ''
        ELSE p.path END AS url_path
 , CASE WHEN e.event_id % 19 = 0 THEN '' ELSE concat('title', CAST(p.page_id AS VARCHAR(10))) END AS title
 , CASE e.event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'url的domain解析失败' WHEN 2 THEN '取值异常'
        ELSE p.host END AS latest_referrer_host
 , CASE e.event_id % 9 WHEN 0 THEN '' WHEN 1 THEN '未取到值' WHEN 2 THEN '取值异常'
        WHEN 3 THEN '未取到值_直接打开' WHEN 4 THEN 'url的domain解析失败'
        ELSE concat('kw', CAST(e.event_id % 5 AS VARCHAR(3))) END AS latest_search_keyword
FROM {joined}
"""
# Every event has the page of its number, counted round over all pages; an event whose page is missing stays.
JOIN_SQL = (
    "(SELECT *, event_id % (SELECT count(*) FROM {pages}) AS page_no FROM {events}) e"
    " LEFT JOIN {paged} p ON p.page_id = e.page_no"
)
DUCKDB_JOIN = JOIN_SQL.format(events="events", pages="pages", paged=f"({PAGES_SQL.replace('{pages}', 'pages')})")


# The same log where some libraries, projects and first-day flags are empty.
BLANK_LOG_SQL = (
    LOG_SQL.replace("ELSE 'MiniProgram' END AS lib", "WHEN e.user_id % 10 = 9 THEN '' ELSE 'MiniProgram' END AS lib")
    .replace("ELSE 'beta' END AS project_name", "WHEN e.user_id % 7 = 5 THEN 'beta' ELSE '' END AS project_name")
    .replace("ELSE 'false' END AS is_first_day", "WHEN e.event_id % 4 = 1 THEN '' ELSE 'false' END AS is_first_day")
)


def sample_log(spark: SparkSession, folder: str, log_sql: str = LOG_SQL) -> DataFrame:
    """The event log over all rows of `events` and `pages`. How the two are joined is left to adaptive execution."""
    events = spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")
    pages = spark.read.schema(PAGES).parquet(f"{folder}/pages.parquet")
    paged = spark.sql(PAGES_SQL, pages=pages)
    return spark.sql(log_sql.replace("{joined}", JOIN_SQL), events=events, pages=pages, paged=paged)
