"""Web, app and mini-program traffic reports as Spark jobs over one event log."""

from footfall.plans import REPORTS, report
from footfall.refresh import refresh_day, refresh_days, refresh_full
from footfall.sources.log import event_log

__all__ = ["REPORTS", "event_log", "refresh_day", "refresh_days", "refresh_full", "report"]
