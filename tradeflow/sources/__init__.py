"""Readers: raw CSV with quarantine, stored layers, views, fixture adapters."""

from tradeflow.sources.files import (
    IngestReport,
    dim_table,
    read_layer,
    read_trades_csv,
    register,
)
from tradeflow.sources.fixtures import account_book_from_events, trades_from_events, trades_raw_from_events

__all__ = [
    "IngestReport",
    "account_book_from_events",
    "dim_table",
    "read_layer",
    "read_trades_csv",
    "register",
    "trades_from_events",
    "trades_raw_from_events",
]
