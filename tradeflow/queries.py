"""Named queries over the driver tables (the contract of ``__spark_entry__``).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Output columns
are rounded the engine-neutral way (``round_half_up``): money to 2 places,
per-trade PnL and averages to 4, prices to 6, bar features to 8; timestamps
are returned as TIMESTAMP_NTZ like the source table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.functions import round_half_up
from tradeflow.model import TradeModel
from tradeflow.operators import (
    counts_by,
    cumulative_tier_pnl,
    daily_tier_pivot,
    day_over_day,
    moving_daily_pnl,
    pnl_by_tier_regime,
    pnl_pivot,
    regime_share,
    round_quantity,
    storage_precision,
    tier_dominance,
    leading_accounts,
    top_in_regime,
    top_n_per_group,
    vol_thresholds,
)
from tradeflow.operators.quality import trade_expectations
from tradeflow.operators.regimes import bar_table
from tradeflow.operators.bitmaps import account_bitmaps, distinct_accounts, number_accounts
from tradeflow.operators.cells import counted_bars
from tradeflow.operators.daily import daily_rollups, gold_a_from_daily, performance_from_daily
from tradeflow.operators.vol_blocks import thresholds_from_blocks, vol_blocks
from tradeflow.operators.economics import (
    attach_account,
    costed_flow,
    priced_labelled_trades,
    with_bar,
    with_base_size,
    with_costs,
    with_fee_schedule,
    with_fill_price,
    with_markout_pnl,
    with_spread,
)
from tradeflow.plans.colocated import ColocatedLayers
from tradeflow.plans.lineage import materialize, shared_checkpoint_dir
from tradeflow.plans.rank_index import RankIndex, changed_rows

# Fixed query arguments on the driver fixture.
REGIME = "high"
Q3_SYMBOLS = ("click", "view")
Q3_START, Q3_END = "2024-01-15", "2024-01-20"
Q4_SYMBOL = "click"
Q4_ROWS = 15
TOP_SYMBOL = "click"

FEATURES = ["mid_min", "prev_mid", "log_return", "sma_20", "sma_60", "vol_20"]


def _r(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: round_half_up(c, places) for c in cols})


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def q_trade_economics(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    df = (
        attach_account(m.raw, m.accounts)
        .transform(with_fee_schedule)
        .transform(with_spread)
        .transform(with_fill_price)
        .transform(with_costs)
        .select("trade_id", "trade_date", "account_id", "tier", "venue", "side",
                "spread_bps", "fee_bps", "fill_price", "notional", "fee_amount")
    )
    return _r(_r(df, 6, "fill_price", "fee_amount"), 4, "notional")


def q_round_quantity_bands(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    base = with_markout_pnl(costed_flow(m.flow), m.bars).withColumn("base_qty", F.col("quantity") / F.col("mid_price"))
    df = base.select(
        "trade_id", "mid_price", "fill_price", "notional", "fee_amount", "realized_pnl",
        round_half_up("base_qty", 8).alias("base_qty"),
        round_quantity("base_qty", "mid_price").alias("quantity_rounded"),
    )
    return storage_precision(df)


def q_dimension_lookup(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return (
        attach_account(m.raw.select("trade_id", "account_id"), m.accounts)
        .transform(with_fee_schedule)
        .transform(with_base_size)
        .select("trade_id", "account_id", "tier", "fee_bps", "base_size")
    )


def q_accounts_per_tier(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return counts_by(m.accounts, "tier", "n_accounts")


def q_mid_lookup(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    df = with_bar(m.raw.select("trade_id", "symbol", "mid_price", "ts"), m.bars, "mid_min").drop("ts")
    return _ntz(_r(df, 8, "mid_min"), "ts_min")


def q_minute_bars(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _ntz(_r(m.bars, 8, "mid_min"), "ts_min")


def q_bar_features(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _ntz(_r(m.features, 8, *FEATURES), "ts_min")


def q_vol_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _r(m.thresholds, 8, "vol_lo", "vol_hi")


def q_bar_regimes(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    df = m.labelled_bars.select("symbol", "ts_min", "mid_min", "vol_20", "sma_20", "sma_60",
                                "vol_regime", "trend_regime")
    return _ntz(_r(df, 8, "mid_min", "vol_20", "sma_20", "sma_60"), "ts_min")


def q_forward_markout(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    df = with_markout_pnl(costed_flow(m.flow), m.bars).select(
        "trade_id", "symbol", "side", "fill_price", "quantity", "realized_pnl", "ts_min", "fwd_mid")
    return _ntz(_r(_r(_r(df, 6, "fill_price"), 8, "fwd_mid"), 4, "realized_pnl"), "ts_min")


def q_silver_trades(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_rounded(TradeModel(spark, sf).silver)


def _silver_rounded(silver: DataFrame) -> DataFrame:
    df = _r(silver, 6, "fill_price", "mid_price", "fee_amount")
    df = _r(df, 4, "notional", "realized_pnl", "net_pnl")
    df = _r(df, 8, "vol_20", "sma_20", "sma_60")
    return _ntz(df, "ts", "ts_min")


def q_silver_colocated(spark: SparkSession, sf: str) -> DataFrame:
    # silver from a colocated store of the flow and the bars: the join moves no trade
    m = TradeModel(spark, sf)
    store = ColocatedLayers(spark, f"{shared_checkpoint_dir(spark).rstrip('/')}/tradeflow/colocated-{uuid.uuid4().hex}")
    counted = materialize(counted_bars(m.raw), "counted_bars")
    store.plan(counted)
    store.write_trades(m.flow)
    store.write_bars(bar_table(counted.drop("n_trades")))
    return _silver_rounded(priced_labelled_trades(store.trades, None, store.bars, on=store.keys))


def q_vol_thresholds_merged(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    blocks = materialize(vol_blocks(m.features.withColumn("trade_date", F.to_date("ts_min"))), "vol_blocks")
    return _r(thresholds_from_blocks(blocks), 8, "vol_lo", "vol_hi")


def q_regime_symbol_merged(spark: SparkSession, sf: str) -> DataFrame:
    merged = gold_a_from_daily(materialize(daily_rollups(TradeModel(spark, sf).silver), "daily_rollups"))
    return _r(_r(merged, 2, "gross_notional", "total_fees", "total_pnl"), 4, "avg_pnl_per_trade", "pnl_stddev")


def q_account_performance_merged(spark: SparkSession, sf: str) -> DataFrame:
    merged = performance_from_daily(materialize(daily_rollups(TradeModel(spark, sf).silver), "daily_rollups"))
    return _r(merged, 2, "total_pnl", "gross_notional", "total_fees")


def q_distinct_accounts_range(spark: SparkSession, sf: str) -> DataFrame:
    silver = materialize(TradeModel(spark, sf).silver.select("trade_date", "tier", "vol_regime", "account_id").distinct(), "seen")
    bitmaps = materialize(account_bitmaps(silver, materialize(number_accounts(silver), "account_numbers")), "account_bitmaps")
    return distinct_accounts(bitmaps, start=Q3_START, end=Q3_END)


def q_regime_symbol_rollup(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _r(_r(m.gold_a, 2, "gross_notional", "total_fees", "total_pnl"), 4,
              "avg_pnl_per_trade", "pnl_stddev")


def q_account_performance(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _r(m.perf, 2, "total_pnl", "gross_notional", "total_fees")


def q_account_ranking(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _r(m.gold_b, 2, "total_pnl", "gross_notional", "total_fees", "cumulative_pnl")


def q_account_ranking_indexed(spark: SparkSession, sf: str) -> DataFrame:
    # the ranking of the first days, kept, and then changed to that of all days
    daily = materialize(daily_rollups(TradeModel(spark, sf).silver), "daily_rollups")
    before = materialize(performance_from_daily(daily.filter(F.col("trade_date") < F.lit(Q3_START).cast("date"))), "perf")
    after = materialize(performance_from_daily(daily), "perf")
    index = RankIndex(spark, f"{shared_checkpoint_dir(spark).rstrip('/')}/tradeflow/rank-{uuid.uuid4().hex}")
    index.build(before)
    index.change(*changed_rows(before, after))
    return _r(index.ranking(), 2, "total_pnl", "gross_notional", "total_fees", "cumulative_pnl")


def q_day_tier_trend_rollup(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    return _r(m.gold_c, 2, "total_pnl", "gross_notional")


def q_tier_by_regime(spark: SparkSession, sf: str) -> DataFrame:
    return pnl_by_tier_regime(TradeModel(spark, sf).silver)


def q_top5_high_vol(spark: SparkSession, sf: str) -> DataFrame:
    # ranks are per (regime, symbol): the regime filter goes below them, and a top-5 needs no full ranking
    perf = TradeModel(spark, sf).perf.filter(F.col("vol_regime") == REGIME)
    ranked = top_n_per_group(perf, ["vol_regime", "symbol"], [F.col("total_pnl").desc_nulls_last()], 5)
    return _r(top_in_regime(ranked, REGIME, 5), 2, "total_pnl")


def q_day_over_day(spark: SparkSession, sf: str) -> DataFrame:
    return day_over_day(TradeModel(spark, sf, symbols=Q3_SYMBOLS).silver, Q3_SYMBOLS, Q3_START, Q3_END)


def q_moving_daily_pnl(spark: SparkSession, sf: str) -> DataFrame:
    return moving_daily_pnl(TradeModel(spark, sf, symbols=(Q4_SYMBOL,)).silver, Q4_SYMBOL, 7, Q4_ROWS)


def q_tier_dominance(spark: SparkSession, sf: str) -> DataFrame:
    return tier_dominance(TradeModel(spark, sf).perf, REGIME)


def q_top3_per_regime_symbol(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    df = top_n_per_group(m.perf, ["vol_regime", "symbol"], [F.col("total_pnl").desc_nulls_last()], 3)
    return _r(df.select("account_id", "tier", "vol_regime", "symbol", "total_pnl", "pnl_rank"), 2, "total_pnl")


def q_top10_one_symbol(spark: SparkSession, sf: str) -> DataFrame:
    df = leading_accounts(TradeModel(spark, sf, symbols=(TOP_SYMBOL,)).perf, REGIME, TOP_SYMBOL, 10).select(
        "account_id", "tier", "vol_regime", "symbol", "n_trades", "total_pnl", "pnl_rank", "pnl_row_num")
    return _r(df, 2, "total_pnl")


def q_regime_share(spark: SparkSession, sf: str) -> DataFrame:
    return _r(regime_share(TradeModel(spark, sf).silver), 8, "share")


def q_pnl_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _r(pnl_pivot(TradeModel(spark, sf).gold_a), 2, "low", "medium", "high")


def q_daily_tier_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _r(daily_tier_pivot(TradeModel(spark, sf).gold_c), 2, "retail", "prop", "market_maker")


def q_cumulative_tier_pnl(spark: SparkSession, sf: str) -> DataFrame:
    return _r(cumulative_tier_pnl(TradeModel(spark, sf).gold_c), 2, "pnl", "cumulative_pnl")


def q_counts_by_day(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    # one trade per flow row: count the flow, not the priced trades
    return m.flow.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count_distinct("account_id").alias("n_accounts"),
    )


def q_null_safe_labels(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    labelled = with_bar(m.raw.select("symbol", "ts"), m.labelled_bars, "vol_20", "vol_regime", "trend_regime")
    return labelled.groupBy("vol_regime", "trend_regime").agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count_if(F.col("vol_20").isNull()).alias("n_null_vol"),
        F.count_if(F.col("vol_regime") != "unknown").alias("n_in_vol_gold"),
        F.count_if(F.col("trend_regime") != "unknown").alias("n_in_trend_gold"),
    )


def q_expectation_report(spark: SparkSession, sf: str) -> DataFrame:
    m = TradeModel(spark, sf)
    rules = trade_expectations()
    checked = costed_flow(m.flow).select(*[F.coalesce(rule, F.lit(False)).alias(name) for name, rule in rules.items()])
    counts = checked.agg(*[F.count_if(~F.col(n)).alias(n) for n in rules])
    return counts.unpivot([], list(rules), "rule", "n_failed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trade_economics": q_trade_economics,
    "round_quantity_bands": q_round_quantity_bands,
    "dimension_lookup": q_dimension_lookup,
    "accounts_per_tier": q_accounts_per_tier,
    "mid_lookup": q_mid_lookup,
    "minute_bars": q_minute_bars,
    "bar_features": q_bar_features,
    "vol_thresholds": q_vol_thresholds,
    "bar_regimes": q_bar_regimes,
    "forward_markout": q_forward_markout,
    "silver_trades": q_silver_trades,
    "silver_colocated": q_silver_colocated,
    "vol_thresholds_merged": q_vol_thresholds_merged,
    "regime_symbol_merged": q_regime_symbol_merged,
    "account_performance_merged": q_account_performance_merged,
    "distinct_accounts_range": q_distinct_accounts_range,
    "regime_symbol_rollup": q_regime_symbol_rollup,
    "account_performance": q_account_performance,
    "account_ranking": q_account_ranking,
    "account_ranking_indexed": q_account_ranking_indexed,
    "day_tier_trend_rollup": q_day_tier_trend_rollup,
    "tier_by_regime": q_tier_by_regime,
    "top5_high_vol": q_top5_high_vol,
    "day_over_day": q_day_over_day,
    "moving_daily_pnl": q_moving_daily_pnl,
    "tier_dominance": q_tier_dominance,
    "top3_per_regime_symbol": q_top3_per_regime_symbol,
    "top10_one_symbol": q_top10_one_symbol,
    "regime_share": q_regime_share,
    "pnl_pivot": q_pnl_pivot,
    "daily_tier_pivot": q_daily_tier_pivot,
    "cumulative_tier_pnl": q_cumulative_tier_pnl,
    "counts_by_day": q_counts_by_day,
    "null_safe_labels": q_null_safe_labels,
    "expectation_report": q_expectation_report,
}
