"""Events merged into cells: the finest rows from which the reports of a refresh are rolled up.

Cells are events alike in all columns that a family of reports groups or filters by, with how many they are and when the first and
the last of them came. That loses nothing those reports ask for: they count events, take the first and last moment of a
session, and tell visitors and addresses apart, all of which a cell has. So a day's log is read once for each family, and the
days that a report looks back to are read as cells, never as events again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.sources.log import ENDED, EVENTS, STARTED, event_log


@dataclass(frozen=True)
class Cells:
    """A family of cells: the table that keeps them, and the columns in which their events are alike."""

    table: str
    columns: tuple[str, ...]
    #: Rows of a file are sorted by these: what filters ask for first.
    order: tuple[str, ...] = ("event", "event_session_id")

    def of(self, log: DataFrame) -> DataFrame:
        """The cells of a log, or of finer cells."""
        return event_log(log).groupBy("stat_date", *self.columns).agg(
            F.sum(EVENTS).alias(EVENTS), F.min(STARTED).alias(STARTED), F.max(ENDED).alias(ENDED)
        )


WHO = ("lib", "event", "project_name", "is_first_day", "distinct_id", "event_session_id", "country", "province", "client_ip")

#: For the reports that do not look at pages: all that one session does within an hour, from one place and source.
SESSION_CELLS = Cells(
    "session_cells", ("stat_hour", *WHO, "city", "manufacturer", "latest_referrer_host", "latest_search_keyword")
)
#: For the page reports, to the second, since page flow asks which page came first and last.
PAGE_CELLS = Cells("page_cells", ("log_time", *WHO, "url", "url_path", "title"))
