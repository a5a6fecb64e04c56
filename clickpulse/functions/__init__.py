"""Column-level functions (built-in expressions only, no Python row code)."""

from clickpulse.functions.decode import (
    parse_clicks,
    parse_clicks_strict,
    parse_transactions,
    value_as_string,
)
from clickpulse.functions.encode import click_json, page_stats_json, transaction_csv

__all__ = [
    "value_as_string",
    "parse_clicks",
    "parse_clicks_strict",
    "parse_transactions",
    "click_json",
    "page_stats_json",
    "transaction_csv",
]
