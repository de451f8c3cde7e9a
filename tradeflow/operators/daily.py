"""Gold by delta (A2, A3, A4): mergeable roll-ups per day.

A day's trades are rolled up once into rows that merge: counts and sums add up,
and the spread of the PnL is kept as count, mean and sum of squared deviations
(M2), which merge as

    M2 = sum of M2 of the days + sum of n (mean of the day - mean)^2

The three gold tables come from these rows alone, so a day that changes is
rolled up again by itself; old days' trades are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.operators.rollups import labelled

#: the roll-ups and their keys beside the day
DAILY_SETS = {
    "regime": ["vol_regime", "symbol"],
    "account": ["account_id", "tier", "vol_regime", "symbol"],
    "trend": ["tier", "trend_regime"],
}
_KEYS = ["vol_regime", "symbol", "account_id", "tier", "trend_regime"]
_SUMS = {"gross_notional": "notional", "total_fees": "fee_amount", "total_pnl": "net_pnl"}


def daily_rollups(silver: DataFrame) -> DataFrame:
    """Every roll-up of every day, from one scan: keys, ``rollup``, ``trade_date``, counts, sums and moments."""
    keys = ["trade_date", *_KEYS]
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    name = None
    for rollup, own in DAILY_SETS.items():
        absent = sum(b for k, b in bit.items() if k not in own and k != "trade_date")
        name = F.when(F.grouping_id() == absent, rollup) if name is None else name.when(F.grouping_id() == absent, rollup)
    pnl = F.col("net_pnl")
    return silver.groupingSets([["trade_date", *own] for own in DAILY_SETS.values()], *keys).agg(
        name.alias("rollup"), F.count(F.lit(1)).alias("n_trades"), *[F.sum(c).alias(a) for a, c in _SUMS.items()],
        F.count(pnl).alias("n_pnl"), F.avg(pnl).alias("mean_pnl"), (F.var_pop(pnl) * F.count(pnl)).alias("m2_pnl"))


def _of(daily: DataFrame, rollup: str) -> DataFrame:
    return daily.filter(F.col("rollup") == rollup)


def gold_a_from_daily(daily: DataFrame) -> DataFrame:
    """A2 / gold A, equal to ``rollup_regime_symbol`` over the days' silver."""
    keys = DAILY_SETS["regime"]
    days = labelled(_of(daily, "regime"))
    # a row a day in each window: roll-ups, not trades
    every = Window.partitionBy(*keys)
    mean = F.try_divide(F.sum(F.col("n_pnl") * F.col("mean_pnl")).over(every), F.sum("n_pnl").over(every))
    away = days.withColumn("_mean", mean)
    off = F.col("mean_pnl") - F.col("_mean")
    return away.groupBy(*keys).agg(
        F.sum("n_trades").alias("n_trades"), *[F.sum(a).alias(a) for a in _SUMS],
        F.max("_mean").alias("avg_pnl_per_trade"),
        F.sqrt(F.try_divide(F.sum("m2_pnl") + F.sum(F.col("n_pnl") * off * off), F.sum("n_pnl"))).alias("pnl_stddev"))


def performance_from_daily(daily: DataFrame) -> DataFrame:
    """A3, equal to ``account_performance`` over the days' silver: the ranking's input."""
    return labelled(_of(daily, "account")).groupBy(*DAILY_SETS["account"]).agg(
        F.sum("n_trades").alias("n_trades"), F.sum("total_pnl").alias("total_pnl"),
        F.sum("gross_notional").alias("gross_notional"), F.sum("total_fees").alias("total_fees"))


def gold_c_from_daily(daily: DataFrame) -> DataFrame:
    """A4 / gold C, equal to ``rollup_day_tier_trend`` over the days' silver."""
    return labelled(_of(daily, "trend"), "trend_regime").select(
        "trade_date", *DAILY_SETS["trend"], "n_trades", "total_pnl", "gross_notional")
