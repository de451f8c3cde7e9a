"""Day-level time series.

Every window here runs on a pre-aggregated daily table (one row per day and
symbol or tier), so a window partition holds at most the number of days in
the history, never trade volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import round_half_up
from tradeflow.operators.economics import TIERS
from tradeflow.operators.reports import daily_tier_pivot
from tradeflow.operators.rollups import daily_symbol_pnl


def day_over_day(silver: DataFrame, symbols: Sequence[str], start: str, end: str) -> DataFrame:
    """Daily PnL, previous day's PnL and the change, per symbol.

    The symbol and date filters run before the aggregate (and prune the silver
    layer's partitions), so the first day in range has no previous day (D12).
    The change rounds the difference, not the difference of rounded values (D11).
    """
    w = Window.partitionBy("symbol").orderBy("trade_date")
    wanted = F.col("symbol").isin(list(symbols)) & F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    daily = daily_symbol_pnl(silver.filter(wanted))
    prev = F.lag("pnl", 1).over(w)
    return daily.select(
        "trade_date",
        "symbol",
        round_half_up("pnl", 2).alias("pnl"),
        round_half_up(prev, 2).alias("prev_day_pnl"),
        round_half_up(F.col("pnl") - prev, 2).alias("day_change"),
    ).orderBy("symbol", "trade_date")


def moving_daily_pnl(silver: DataFrame, symbol: str, days: int = 7, n: int | None = 15) -> DataFrame:
    """Daily PnL and its ``days``-row moving average for one symbol.

    The symbol filter is on the window's partition key, so Catalyst pushes it
    below the window and the aggregate down to the scan.  The average is over
    rows (partial at the start, D13); the limit applies after the window.
    """
    w = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(-(days - 1), 0)
    out = (
        daily_symbol_pnl(silver).select(
            "trade_date",
            "symbol",
            round_half_up("pnl", 2).alias("daily_pnl"),
            round_half_up(F.avg("pnl").over(w), 2).alias(f"ma{days}_pnl"),
        )
        .filter(F.col("symbol") == symbol)
        .orderBy("trade_date")
    )
    return out.limit(n) if n is not None else out


def cumulative_tier_pnl(gold_c: DataFrame, tiers: Sequence[str] = TIERS) -> DataFrame:
    """Running PnL per tier through time, absent (day, tier) counted as 0.

    Densify with the day x tier pivot (fixed tier list, no cross join), melt it
    back, then a running sum per tier ordered by day.
    """
    wide = daily_tier_pivot(gold_c, tiers)
    long = wide.unpivot("trade_date", list(tiers), "tier", "pnl")
    w = Window.partitionBy("tier").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return long.withColumn("cumulative_pnl", F.sum("pnl").over(w))
