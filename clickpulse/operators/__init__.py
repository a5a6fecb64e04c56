"""DataFrame -> DataFrame operators; each works on batch and streaming frames."""

from clickpulse.operators.ordering import latest_windows, top_report
from clickpulse.operators.spend import dedupe_spend, spend_by_account
from clickpulse.operators.totals import all_time_totals, with_report_date
from clickpulse.operators.visits import page_visits
from clickpulse.operators.windows import page_stats, reaggregate_speed, window_counts

__all__ = [
    "window_counts",
    "reaggregate_speed",
    "page_stats",
    "all_time_totals",
    "with_report_date",
    "latest_windows",
    "top_report",
    "dedupe_spend",
    "spend_by_account",
    "page_visits",
]
