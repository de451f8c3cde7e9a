"""Trade economics (C3-C6, E1-E4, J3): pricing, costs and markout PnL.

All of it is projection work on the trade rows; the only joins are the
account dimension (J3) and the forward-mid lookup (E3), both equi-joins that
AQE turns into broadcasts at run time when the small side measures small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import case_map, minute_of, round_half_up, side_sign
from tradeflow.schema import TRADE_COLUMNS

# Fixed values of the trade economics.
FEE_BPS_BY_TIER = {"retail": 25.0, "prop": 8.0, "market_maker": 2.0}
BASE_SIZE_BY_TIER = {"retail": 500.0, "prop": 25000.0, "market_maker": 250000.0}
SPREAD_BPS_BY_VENUE = {"coinbase": 4.0, "binance": 2.0, "kraken": 6.0}
TIERS = ["retail", "prop", "market_maker"]
BPS = 10000.0
MARKOUT_MINUTES = 30
# What a trade shares with its minute bar.
BAR_KEYS = ("symbol", "ts_min")
# Quantity precision by price band: mid > 1000 -> 4 dp, mid > 10 -> 2 dp, else 1 dp.
QUANTITY_BANDS = [(1000.0, 4), (10.0, 2)]
QUANTITY_FLOOR_PLACES = 1
# Storage precision of the priced columns.
STORAGE_PLACES = {"fill_price": 6, "mid_price": 6, "notional": 4, "fee_amount": 6, "realized_pnl": 6}


def attach_account(trades: DataFrame, accounts: DataFrame, key: str = "account_id") -> DataFrame:
    """Look up account attributes (tier, ...) for every trade.

    Left join so unknown accounts keep their trades.  No broadcast hint: the
    account book grows with the business, so AQE decides from its measured
    size (broadcast below the threshold, sort-merge beyond it).
    """
    return trades.join(accounts, on=key, how="left")


def with_fee_schedule(df: DataFrame, tier: str = "tier") -> DataFrame:
    """Fee in basis points by account tier."""
    return df.withColumn("fee_bps", case_map(tier, FEE_BPS_BY_TIER))


def with_base_size(df: DataFrame, tier: str = "tier") -> DataFrame:
    """Base order size (quote currency) by account tier."""
    return df.withColumn("base_size", case_map(tier, BASE_SIZE_BY_TIER))


def with_spread(df: DataFrame, venue: str = "venue") -> DataFrame:
    """C4: quoted spread in basis points by venue."""
    return df.withColumn("spread_bps", case_map(venue, SPREAD_BPS_BY_VENUE))


def fill_price(mid: Column, sign: Column, spread_bps: Column) -> Column:
    """Mid +/- half the spread."""
    return mid * (F.lit(1.0) + sign * spread_bps / F.lit(2.0) / F.lit(BPS))


def with_fill_price(df: DataFrame) -> DataFrame:
    """E1 on a frame that has mid_price, side and spread_bps."""
    return df.withColumn("fill_price", fill_price(F.col("mid_price"), side_sign("side"), F.col("spread_bps")))


def with_costs(df: DataFrame) -> DataFrame:
    """notional = fill x quantity, fee = notional x bps / 10 000."""
    notional = F.col("fill_price") * F.col("quantity")
    return df.withColumns({
        "notional": notional,
        "fee_amount": notional * F.col("fee_bps") / F.lit(BPS),
    })


def markout_pnl(sign: Column, fwd: Column, fill: Column, qty: Column, fee: Column) -> Column:
    """Signed forward markout times quantity, net of fees."""
    return sign * (fwd - fill) * qty - fee


def with_bar(trades: DataFrame, bars: DataFrame, *columns: str, on: Sequence[str] = BAR_KEYS) -> DataFrame:
    """``columns`` of each trade's minute bar, by (symbol, ts_min); every trade is kept.

    ``bars`` holds a minute once, so the left join repeats no trade.  ``on`` adds
    a storage key (``operators.cells``) that both sides carry.
    """
    return trades.withColumn("ts_min", minute_of("ts")).join(bars.select(*on, *columns), on=list(on), how="left")


def with_markout_pnl(df: DataFrame, bars: DataFrame, horizon_minutes: int = MARKOUT_MINUTES) -> DataFrame:
    """Realized PnL against the mid ``horizon_minutes`` later.

    ``bars`` are the (symbol, ts_min, mid_min) minute bars.  The forward mid is
    computed once per bar (J5) and joined to trades on the exact bar key (J4).
    """
    from tradeflow.operators.markout import forward_mid

    pnl = markout_pnl(side_sign("side"), F.col("fwd_mid"), F.col("fill_price"), F.col("quantity"), F.col("fee_amount"))
    return with_bar(df, forward_mid(bars, minutes=horizon_minutes), "fwd_mid").withColumn("realized_pnl", pnl)


def round_quantity(qty: str | Column, mid: str | Column) -> Column:
    """Round a quantity to the precision of its price band."""
    q = F.col(qty) if isinstance(qty, str) else qty
    m = F.col(mid) if isinstance(mid, str) else mid
    expr = None
    for bound, places in QUANTITY_BANDS:
        rounded = round_half_up(q, places)
        expr = F.when(m > bound, rounded) if expr is None else expr.when(m > bound, rounded)
    return expr.otherwise(round_half_up(q, QUANTITY_FLOOR_PLACES))


def storage_precision(df: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    """Round priced columns to their storage precision."""
    places = places or STORAGE_PLACES
    return df.withColumns({c: round_half_up(c, n) for c, n in places.items() if c in df.columns})


def costed_flow(raw: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Raw order flow -> account tier, fee, spread, fill, notional and fee amount.

    ``accounts`` is the account book to look tiers up in (J3); pass ``None``
    when the flow already carries ``tier`` (as the trades file does).
    """
    flow = raw if accounts is None else attach_account(raw, accounts)
    return (
        flow.transform(with_fee_schedule)
        .transform(with_spread)
        .transform(with_fill_price)
        .transform(with_costs)
    )


def priced_labelled_trades(raw: DataFrame, accounts: DataFrame | None, bar_attrs: DataFrame,
                           on: Sequence[str] = BAR_KEYS) -> DataFrame:
    """Silver in one pass over the trade flow: costs, markout PnL and regime labels.

    ``bar_attrs`` is ``regimes.bar_table`` (labels + ``fwd_mid`` per bar), so the
    trades meet the bars in a single equi-join on (symbol, ts_min).  Equal to
    ``attach_labels(priced_trades(raw, accounts), labelled_bars)``.
    """
    from tradeflow.operators.regimes import BAR_LABEL_COLUMNS

    pnl = markout_pnl(side_sign("side"), F.col("fwd_mid"), F.col("fill_price"),
                      F.col("quantity"), F.col("fee_amount"))
    silver_cols = TRADE_COLUMNS + ["ts_min"] + BAR_LABEL_COLUMNS[2:] + ["net_pnl"]
    return (
        with_bar(costed_flow(raw, accounts), bar_attrs, *BAR_LABEL_COLUMNS[2:], "fwd_mid", on=on)
        .withColumns({"realized_pnl": pnl, "net_pnl": pnl})
        .select(*silver_cols)
    )


def priced_trades(raw: DataFrame, accounts: DataFrame | None, horizon_minutes: int = MARKOUT_MINUTES,
                  bars: DataFrame | None = None) -> DataFrame:
    """Raw order flow + account book -> full trade rows in the raw schema.

    The minute bars for the markout come from the raw flow (only symbol, ts
    and mid_price are read), so pricing never waits on itself; pass already
    built ``bars`` to avoid aggregating the flow again.
    """
    from tradeflow.operators.bars import minute_bars

    priced = costed_flow(raw, accounts)
    bars = bars if bars is not None else minute_bars(raw)
    return with_markout_pnl(priced, bars, horizon_minutes).select(*TRADE_COLUMNS)
