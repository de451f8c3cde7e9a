"""Adapter from the driver's ``events`` table to the trade data model.

``events(event_id, ts, user_id, event_type, value, props)`` carries real
intraday timestamps, so it stands in for the raw trades feed:

* ``trade_id``   = 'T' || (1000000 + event_id)
* ``ts``         = event time truncated to the second
* ``account_id`` = 'ACC' || (1000 + user_id % 32)
* ``symbol``     = event_type
* ``venue``      = by event_id % 3, ``side`` by event_id % 2
* ``mid_price``  = 100 + value, ``quantity`` = 1 + props.k

Account tiers follow from the account (an account book derived from the same
table, or the same rule as a projection); fees, fills and the 30-minute
markout PnL are computed by the economics operators, so the result has
exactly the raw trade schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import case_map

# Fixed values of the adapter.
N_ACCOUNTS = 32
ACCOUNT_BASE = 1000
TRADE_ID_BASE = 1000000
VENUE_BY_MOD3 = {0: "coinbase", 1: "binance", 2: "kraken"}
SIDE_BY_MOD2 = {0: "BUY", 1: "SELL"}
# tier by account index: [0, 18) retail, [18, 27) prop, [27, 32) market_maker
TIER_BOUNDS = [(18, "retail"), (27, "prop"), (N_ACCOUNTS, "market_maker")]
MID_BASE = 100.0


def _account_index() -> F.Column:
    return F.col("user_id") % N_ACCOUNTS


def _account_id(idx: F.Column) -> F.Column:
    return F.concat(F.lit("ACC"), (F.lit(ACCOUNT_BASE) + idx).cast("string"))


def trades_raw_from_events(events: DataFrame, with_tier: bool = False) -> DataFrame:
    """Raw order flow: one row per event, before any pricing or accounting.

    ``with_tier`` attaches the account tier by its rule, as the trades file
    carries it - the same tiers a lookup in ``account_book_from_events`` gives,
    as a projection instead of a join.
    """
    eid = F.col("event_id")
    extra = [_tier(_account_index()).alias("tier")] if with_tier else []
    return events.select(
        F.concat(F.lit("T"), (F.lit(TRADE_ID_BASE) + eid).cast("string")).alias("trade_id"),
        F.date_trunc("second", F.col("ts")).alias("ts"),
        _account_id(_account_index()).alias("account_id"),
        F.col("event_type").alias("symbol"),
        case_map(eid % 3, VENUE_BY_MOD3).alias("venue"),
        case_map(eid % 2, SIDE_BY_MOD2).alias("side"),
        (F.lit(1.0) + F.get_json_object("props", "$.k").cast("double")).alias("quantity"),
        (F.lit(MID_BASE) + F.col("value")).alias("mid_price"),
        F.col("ts").cast("date").alias("trade_date"),
        *extra,
    )


def _tier(idx: F.Column) -> F.Column:
    tier = None
    for bound, name in TIER_BOUNDS:
        tier = F.when(idx < bound, name) if tier is None else tier.when(idx < bound, name)
    return tier


def account_book_from_events(events: DataFrame) -> DataFrame:
    """Account dimension (account_id, tier) derived from the users in ``events``.

    ``distinct`` is partially aggregated per map task, so the shuffle carries at
    most one row per account per task whatever the event volume.
    """
    idx = _account_index()
    return events.select(_account_id(idx).alias("account_id"), _tier(idx).alias("tier")).distinct()


def trades_from_events(events: DataFrame, horizon_minutes: int = 30) -> DataFrame:
    """Full trade rows (raw 15-column schema, ``trade_date`` as DATE)."""
    from tradeflow.operators.economics import priced_trades

    return priced_trades(trades_raw_from_events(events, with_tier=True), None, horizon_minutes=horizon_minutes)
