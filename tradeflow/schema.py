"""Schemas of the raw trades file and the stored layers."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw landing schema (15 columns).  trade_date arrives as YYYY-MM-DD text.
TRADE_SCHEMA = StructType([
    StructField("trade_id", StringType()),
    StructField("ts", TimestampType()),
    StructField("account_id", StringType()),
    StructField("tier", StringType()),
    StructField("symbol", StringType()),
    StructField("venue", StringType()),
    StructField("side", StringType()),
    StructField("quantity", DoubleType()),
    StructField("fill_price", DoubleType()),
    StructField("mid_price", DoubleType()),
    StructField("notional", DoubleType()),
    StructField("fee_bps", DoubleType()),
    StructField("fee_amount", DoubleType()),
    StructField("realized_pnl", DoubleType()),
    StructField("trade_date", StringType()),
])

TRADE_COLUMNS = [f.name for f in TRADE_SCHEMA.fields]

# From bronze on, trade_date is a DATE everywhere (never re-inferred).
BRONZE_SCHEMA = StructType(
    [f if f.name != "trade_date" else StructField("trade_date", DateType()) for f in TRADE_SCHEMA.fields]
)

BAR_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("ts_min", TimestampType()),
    StructField("mid_min", DoubleType()),
])

LABEL_COLUMNS = ["vol_20", "sma_20", "sma_60", "vol_regime", "trend_regime"]

SILVER_SCHEMA = StructType(
    BRONZE_SCHEMA.fields
    + [
        StructField("ts_min", TimestampType()),
        StructField("vol_20", DoubleType()),
        StructField("sma_20", DoubleType()),
        StructField("sma_60", DoubleType()),
        StructField("vol_regime", StringType()),
        StructField("trend_regime", StringType()),
        StructField("net_pnl", DoubleType()),
    ]
)

REGIME_ROLLUP_SCHEMA = StructType([
    StructField("vol_regime", StringType()),
    StructField("symbol", StringType()),
    StructField("n_trades", LongType()),
    StructField("gross_notional", DoubleType()),
    StructField("total_fees", DoubleType()),
    StructField("total_pnl", DoubleType()),
    StructField("avg_pnl_per_trade", DoubleType()),
    StructField("pnl_stddev", DoubleType()),
])

ACCOUNT_RANKING_SCHEMA = StructType([
    StructField("account_id", StringType()),
    StructField("tier", StringType()),
    StructField("vol_regime", StringType()),
    StructField("symbol", StringType()),
    StructField("n_trades", LongType()),
    StructField("total_pnl", DoubleType()),
    StructField("gross_notional", DoubleType()),
    StructField("total_fees", DoubleType()),
    StructField("pnl_rank", LongType()),
    StructField("pnl_row_num", LongType()),
    StructField("cumulative_pnl", DoubleType()),
])

DAY_TIER_TREND_SCHEMA = StructType([
    StructField("trade_date", DateType()),
    StructField("tier", StringType()),
    StructField("trend_regime", StringType()),
    StructField("n_trades", LongType()),
    StructField("total_pnl", DoubleType()),
    StructField("gross_notional", DoubleType()),
])

FEATURE_SCHEMA = StructType([
    StructField("symbol", StringType()),
    StructField("ts_min", TimestampType()),
    StructField("mid_min", DoubleType()),
    StructField("prev_mid", DoubleType()),
    StructField("log_return", DoubleType()),
    StructField("sma_20", DoubleType()),
    StructField("sma_60", DoubleType()),
    StructField("vol_20", DoubleType()),
    StructField("trade_date", DateType()),
])

BAR_LAYER_SCHEMA = StructType(BAR_SCHEMA.fields + [StructField("trade_date", DateType())])

# Minute bars with the number of trades behind each.
COUNTED_BAR_SCHEMA = StructType(BAR_LAYER_SCHEMA.fields + [StructField("n_trades", LongType())])
