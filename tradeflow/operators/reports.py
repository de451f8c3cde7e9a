"""Chart feeds as Spark results (A10-A12): pivots with missing cells as 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.operators.economics import TIERS
from tradeflow.operators.regimes import VOL_LABELS


def pnl_pivot(gold_a: DataFrame, regimes: Sequence[str] = VOL_LABELS) -> DataFrame:
    """Total PnL per symbol, one column per volatility regime, missing -> 0.

    The pivot values are given, so Spark needs no extra pass to discover them.
    """
    return (
        gold_a.groupBy("symbol")
        .pivot("vol_regime", list(regimes))
        .agg(F.sum("total_pnl"))
        .fillna(0.0, subset=list(regimes))
    )


def daily_tier_pivot(gold_c: DataFrame, tiers: Sequence[str] = TIERS) -> DataFrame:
    """Total PnL per day, one column per tier, missing -> 0."""
    return (
        gold_c.groupBy("trade_date")
        .pivot("tier", list(tiers))
        .agg(F.sum("total_pnl"))
        .fillna(0.0, subset=list(tiers))
    )
