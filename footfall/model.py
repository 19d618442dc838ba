"""The event log: its columns, and the fixed values the tracker writes into them."""

from __future__ import annotations

from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("stat_date", T.DateType()),
        T.StructField("stat_hour", T.StringType()),
        T.StructField("log_time", T.TimestampNTZType()),
        T.StructField("lib", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("project_name", T.StringType()),
        T.StructField("is_first_day", T.StringType()),
        T.StructField("distinct_id", T.StringType()),
        T.StructField("event_session_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("client_ip", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("url_path", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("latest_referrer_host", T.StringType()),
        T.StructField("latest_search_keyword", T.StringType()),
    ]
)

# Event that is a page view, per tracking library.
PAGE_VIEW_EVENTS = {
    "js": "$pageview",
    "iOS": "$AppViewScreen",
    "Android": "$AppViewScreen",
    "MiniProgram": "$MPViewScreen",
}

# Markers the tracker writes instead of a host, url or search word.
DOMAIN_PARSE_FAILED = "url的domain解析失败"
VALUE_ABNORMAL = "取值异常"
NOT_TAKEN = "未取到值"
NOT_TAKEN_DIRECT = "未取到值_直接打开"
SEARCH_WORD_MARKERS = (VALUE_ABNORMAL, NOT_TAKEN_DIRECT, NOT_TAKEN, DOMAIN_PARSE_FAILED, "")

# How rolled-up and unknown dimension values read in the reports.
ALL = "all"
NOT_AVAILABLE = "N/A"
UNKNOWN = "未知"
UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_PROVINCE = "未知省份"
UNKNOWN_CITY = "未知城市"
DIRECT_ACCESS = "直接访问"

# Days looked back for the first day of a visit, and for the lifecycle of a visitor.
VISIT_LOOK_BACK = 7
LIFECYCLE_LOOK_BACK = 3
