"""Which tracked events are page views. Conditions are SQL texts over the log columns."""

from __future__ import annotations

from collections.abc import Iterable

from footfall.model import PAGE_VIEW_EVENTS


def literal(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(column: str, values: Iterable[str]) -> str:
    return f"{column} IN ({', '.join(literal(value) for value in values)})"


_SCREENS = {lib: event for lib, event in PAGE_VIEW_EVENTS.items() if lib != "js"}

# A page view: the event that the row's own library sends for one.
IS_PAGE_VIEW = (
    "("
    + " OR ".join(f"(lib = {literal(lib)} AND event = {literal(event)})" for lib, event in PAGE_VIEW_EVENTS.items())
    + ")"
)

# A page view on the visitor's first day.
IS_NEW_PAGE_VIEW = f"({IS_PAGE_VIEW} AND is_first_day = 'true')"

# The lifecycle's wider rule: apps and mini programs may send each other's screen event.
IS_ACTIVITY = (
    f"((lib = 'js' AND event = {literal(PAGE_VIEW_EVENTS['js'])}) OR"
    f" ({one_of('lib', _SCREENS)} AND {one_of('event', sorted(set(_SCREENS.values())))}))"
)

# The page flow's rule: any page event, whatever the library.
IS_PAGE_EVENT = one_of("event", sorted(set(PAGE_VIEW_EVENTS.values())))

# The same two on the columns as the table has them; a null meets neither.
RAW_ACTIVITY = IS_ACTIVITY.replace("lib ", "raw_lib ").replace("event ", "raw_event ")
RAW_PAGE_EVENT = IS_PAGE_EVENT.replace("event ", "raw_event ")
