"""The dimensions the reports share."""

from __future__ import annotations

from footfall.functions.fields import Field, axis
from footfall.model import (
    DIRECT_ACCESS,
    DOMAIN_PARSE_FAILED,
    SEARCH_WORD_MARKERS,
    UNKNOWN_CITY,
    UNKNOWN_COUNTRY,
    UNKNOWN_PROVINCE,
    VALUE_ABNORMAL,
)

LIB = Field("lib", label=None)
PROJECT = Field("project_name")
FIRST_DAY = Field("is_first_day", label=None)
COUNTRY = Field("country", unknown=("",))
PROVINCE = Field("province", unknown=("",))
NAMED_COUNTRY = Field("country", unknown=("",), label=UNKNOWN_COUNTRY)
NAMED_PROVINCE = Field("province", unknown=("",), label=UNKNOWN_PROVINCE)
NAMED_CITY = Field("city", unknown=("",), label=UNKNOWN_CITY)
MANUFACTURER = Field("manufacturer", unknown=("",))
SEARCH_WORD = Field("latest_search_keyword", excluded=SEARCH_WORD_MARKERS)
FOLDED_SEARCH_WORD = Field("latest_search_keyword", unknown=("",), excluded=SEARCH_WORD_MARKERS)
REFERRER = Field(
    "latest_referrer_host",
    unknown=("", DOMAIN_PARSE_FAILED),
    label=DIRECT_ACCESS,
    excluded=(VALUE_ABNORMAL,),
)
SOURCE_SITE = Field("sourcesite", source="latest_referrer_host", unknown=("",), excluded=(VALUE_ABNORMAL,))
PAGE = axis(
    Field("url", unknown=("", DOMAIN_PARSE_FAILED), label=None),
    Field("url_path", unknown=("",), label=None),
    Field("title", unknown=("",), label=None),
)
PAGE_URL = Field("url", unknown=("",))
PAGE_TITLE = Field("title", unknown=("",))

STANDARD = tuple(axis(field) for field in (LIB, PROJECT, FIRST_DAY, COUNTRY, PROVINCE))
STANDARD_NAMED = tuple(axis(field) for field in (LIB, PROJECT, FIRST_DAY, NAMED_COUNTRY, NAMED_PROVINCE))
