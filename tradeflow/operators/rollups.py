"""Grouped roll-ups.

Each is a single hash aggregate: partial aggregation before the shuffle,
final after it, so hot keys are pre-reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import round_half_up
from tradeflow.operators.regimes import UNKNOWN


def labelled(df: DataFrame, col: str = "vol_regime") -> DataFrame:
    """keep rows with a known label (``<> 'unknown'`` also drops NULL)."""
    return df.filter(F.col(col) != F.lit(UNKNOWN))


def rollup_regime_symbol(silver: DataFrame) -> DataFrame:
    """A2 / gold A: per (vol_regime, symbol) counts, sums, mean and spread of PnL."""
    return (
        labelled(silver)
        .groupBy("vol_regime", "symbol")
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            F.sum("notional").alias("gross_notional"),
            F.sum("fee_amount").alias("total_fees"),
            F.sum("net_pnl").alias("total_pnl"),
            F.avg("net_pnl").alias("avg_pnl_per_trade"),
            F.stddev_pop("net_pnl").alias("pnl_stddev"),
        )
    )


def account_performance(silver: DataFrame) -> DataFrame:
    """A3: per (account, tier, vol_regime, symbol) activity - the ranking input."""
    return (
        labelled(silver)
        .groupBy("account_id", "tier", "vol_regime", "symbol")
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            F.sum("net_pnl").alias("total_pnl"),
            F.sum("notional").alias("gross_notional"),
            F.sum("fee_amount").alias("total_fees"),
        )
    )


def rollup_day_tier_trend(silver: DataFrame) -> DataFrame:
    """A4 / gold C: per (trade_date, tier, trend_regime)."""
    return (
        labelled(silver, "trend_regime")
        .groupBy("trade_date", "tier", "trend_regime")
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            F.sum("net_pnl").alias("total_pnl"),
            F.sum("notional").alias("gross_notional"),
        )
    )


def pnl_by_tier_regime(silver: DataFrame) -> DataFrame:
    """A5 / Q1: PnL by tier across volatility regimes (rounded like the report)."""
    return (
        labelled(silver)
        .groupBy("tier", "vol_regime")
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            round_half_up(F.sum("net_pnl"), 2).alias("total_pnl"),
            round_half_up(F.avg("net_pnl"), 4).alias("avg_pnl"),
            round_half_up(F.sum("fee_amount"), 2).alias("fees_paid"),
        )
        .orderBy("tier", "vol_regime")
    )


def daily_symbol_pnl(silver: DataFrame) -> DataFrame:
    """PnL per (trade_date, symbol) - the input of the day-level windows."""
    return silver.groupBy("trade_date", "symbol").agg(F.sum("net_pnl").alias("pnl"))


def tier_dominance(ranking: DataFrame, regime: str = "high") -> DataFrame:
    """Accounts, trades and PnL per tier inside one volatility regime.

    The regime filter prunes partitions of the stored ranking layer.
    """
    return (
        ranking.filter(F.col("vol_regime") == regime)
        .groupBy("tier")
        .agg(
            F.count_distinct("account_id").alias("n_accounts"),
            F.sum("n_trades").alias("n_trades"),
            round_half_up(F.sum("total_pnl"), 2).alias("total_pnl"),
            round_half_up(F.try_divide(F.sum("total_pnl"), F.sum("n_trades")), 4).alias("pnl_per_trade"),
        )
        .orderBy(F.col("total_pnl").desc_nulls_last(), F.col("tier"))
    )


def regime_share(silver: DataFrame) -> DataFrame:
    """A10: trade count and share of trades per volatility regime.

    The share's denominator is a window over the (at most four-row) grouped
    result, never over trades.
    """
    counts = labelled(silver).groupBy("vol_regime").agg(F.count(F.lit(1)).alias("n_trades"))
    total = F.sum("n_trades").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n_trades") / total)


def counts_by(df: DataFrame, col: str, name: str = "n_rows") -> DataFrame:
    """Rows per value of ``col``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


GOLD_SETS = {
    "gold_a": ["vol_regime", "symbol"],
    "perf": ["account_id", "tier", "vol_regime", "symbol"],
    "gold_c": ["trade_date", "tier", "trend_regime"],
}
_GOLD_KEYS = ["vol_regime", "symbol", "account_id", "tier", "trade_date", "trend_regime"]


def gold_rollups(silver: DataFrame) -> DataFrame:
    """Gold A, account performance and gold C from ONE scan of silver.

    A GROUPING SETS aggregate (one Expand, one partial + final aggregate) with
    ``_set`` naming the grouping each row belongs to.  Each table's filter is
    on one of its own grouping keys, so filtering the groups afterwards equals
    filtering the trades first.  Split with ``gold_from_rollups``.
    """
    bit = {k: 1 << (len(_GOLD_KEYS) - 1 - i) for i, k in enumerate(_GOLD_KEYS)}
    set_name = None
    for name, keys in GOLD_SETS.items():
        gid = sum(b for k, b in bit.items() if k not in keys)
        cond = F.grouping_id() == gid
        set_name = F.when(cond, name) if set_name is None else set_name.when(cond, name)
    return silver.groupingSets(list(GOLD_SETS.values()), *_GOLD_KEYS).agg(
        set_name.alias("_set"),
        F.count(F.lit(1)).alias("n_trades"),
        F.sum("notional").alias("gross_notional"),
        F.sum("fee_amount").alias("total_fees"),
        F.sum("net_pnl").alias("total_pnl"),
        F.avg("net_pnl").alias("avg_pnl_per_trade"),
        F.stddev_pop("net_pnl").alias("pnl_stddev"),
    )


def gold_from_rollups(rollups: DataFrame) -> dict[str, DataFrame]:
    """The three tables, with the same columns as the single-table operators."""
    part = {name: rollups.filter(F.col("_set") == name) for name in GOLD_SETS}
    return {
        "gold_a": labelled(part["gold_a"]).select(
            "vol_regime", "symbol", "n_trades", "gross_notional", "total_fees", "total_pnl",
            "avg_pnl_per_trade", "pnl_stddev"),
        "perf": labelled(part["perf"]).select(
            "account_id", "tier", "vol_regime", "symbol", "n_trades", "total_pnl", "gross_notional",
            "total_fees"),
        "gold_c": labelled(part["gold_c"], "trend_regime").select(
            "trade_date", "tier", "trend_regime", "n_trades", "total_pnl", "gross_notional"),
    }
