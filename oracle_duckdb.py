"""Independent DuckDB SQL for every registered query (the correctness oracle).

pre-registered views (``events`` ...).  Each query is self-contained: a chain
of CTEs from ``events`` to its result.  Rounding uses the same
printed-value rule as the Spark side: the double's shortest decimal form is
parsed into ``decimal(38, 18)`` and rounded half away from zero.
"""

from __future__ import annotations


def r(expr: str, n: int) -> str:
    """Round the printed (shortest) decimal form of a double, half away from zero."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


RAW = """raw AS (
  SELECT 'T' || CAST(1000000 + event_id AS VARCHAR) AS trade_id,
         date_trunc('second', ts) AS ts,
         'ACC' || CAST(1000 + user_id % 32 AS VARCHAR) AS account_id,
         event_type AS symbol,
         CASE event_id % 3 WHEN 0 THEN 'coinbase' WHEN 1 THEN 'binance' WHEN 2 THEN 'kraken' END AS venue,
         CASE event_id % 2 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' END AS side,
         1e0 + CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         100e0 + value AS mid_price,
         CAST(ts AS DATE) AS trade_date
  FROM events)"""

ACCTS = """accts AS (
  SELECT DISTINCT 'ACC' || CAST(1000 + user_id % 32 AS VARCHAR) AS account_id,
         CASE WHEN user_id % 32 < 18 THEN 'retail'
              WHEN user_id % 32 < 27 THEN 'prop'
              WHEN user_id % 32 < 32 THEN 'market_maker' END AS tier
  FROM events)"""

PRICED = """priced AS (
  SELECT r.*, a.tier,
         CASE a.tier WHEN 'retail' THEN 25e0 WHEN 'prop' THEN 8e0 WHEN 'market_maker' THEN 2e0 END AS fee_bps,
         CASE r.venue WHEN 'coinbase' THEN 4e0 WHEN 'binance' THEN 2e0 WHEN 'kraken' THEN 6e0 END AS spread_bps,
         CASE r.side WHEN 'BUY' THEN 1e0 WHEN 'SELL' THEN -1e0 END AS sgn
  FROM raw r LEFT JOIN accts a ON a.account_id = r.account_id),
filled AS (
  SELECT *, mid_price * (1e0 + sgn * spread_bps / 2e0 / 10000e0) AS fill_price FROM priced),
costed AS (
  SELECT *, fill_price * quantity AS notional, fill_price * quantity * fee_bps / 10000e0 AS fee_amount
  FROM filled)"""

BARS = """bars AS (
  SELECT symbol, date_trunc('minute', ts) AS ts_min, avg(mid_price) AS mid_min
  FROM raw GROUP BY symbol, date_trunc('minute', ts))"""

FWD = """fwd AS (
  SELECT symbol, ts_min, mid_min,
         last_value(mid_min) OVER (PARTITION BY symbol ORDER BY ts_min
             RANGE BETWEEN CURRENT ROW AND INTERVAL 30 MINUTE FOLLOWING) AS fwd_mid
  FROM bars)"""

TRADES = """trades AS (
  SELECT c.trade_id, c.ts, c.account_id, c.tier, c.symbol, c.venue, c.side, c.quantity,
         c.fill_price, c.mid_price, c.notional, c.fee_bps, c.fee_amount,
         c.sgn * (f.fwd_mid - c.fill_price) * c.quantity - c.fee_amount AS realized_pnl,
         c.trade_date
  FROM costed c LEFT JOIN fwd f ON f.symbol = c.symbol AND f.ts_min = date_trunc('minute', c.ts))"""

FEAT = """feat0 AS (
  SELECT symbol, ts_min, mid_min,
         lag(mid_min, 1) OVER (PARTITION BY symbol ORDER BY ts_min) AS prev_mid
  FROM bars),
feat1 AS (
  SELECT *, CASE WHEN mid_min / nullif(prev_mid, 0) > 0 THEN ln(mid_min / nullif(prev_mid, 0)) END AS log_return
  FROM feat0),
feat AS (
  SELECT *,
         avg(mid_min) OVER (PARTITION BY symbol ORDER BY ts_min ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma_20,
         avg(mid_min) OVER (PARTITION BY symbol ORDER BY ts_min ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS sma_60,
         stddev_pop(log_return) OVER (PARTITION BY symbol ORDER BY ts_min ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS vol_20
  FROM feat1)"""

THR = """thr AS (
  SELECT symbol, quantile_disc(vol_20, 0.33) AS vol_lo, quantile_disc(vol_20, 0.66) AS vol_hi
  FROM feat WHERE vol_20 IS NOT NULL GROUP BY symbol)"""

LBARS = """lbars AS (
  SELECT f.*,
         CASE WHEN f.vol_20 IS NULL THEN 'unknown'
              WHEN f.vol_20 <= t.vol_lo THEN 'low'
              WHEN f.vol_20 <= t.vol_hi THEN 'medium'
              ELSE 'high' END AS vol_regime,
         CASE WHEN f.sma_20 IS NULL OR f.sma_60 IS NULL THEN 'unknown'
              WHEN f.sma_20 > f.sma_60 * 1.001e0 THEN 'bull'
              WHEN f.sma_20 < f.sma_60 * 0.999e0 THEN 'bear'
              ELSE 'chop' END AS trend_regime
  FROM feat f LEFT JOIN thr t ON t.symbol = f.symbol)"""

SILVER = """silver AS (
  SELECT t.*, date_trunc('minute', t.ts) AS ts_min, b.vol_20, b.sma_20, b.sma_60,
         b.vol_regime, b.trend_regime, t.realized_pnl AS net_pnl
  FROM trades t LEFT JOIN lbars b ON b.symbol = t.symbol AND b.ts_min = date_trunc('minute', t.ts))"""

GOLD_A = """gold_a AS (
  SELECT vol_regime, symbol, count(*) AS n_trades, sum(notional) AS gross_notional,
         sum(fee_amount) AS total_fees, sum(net_pnl) AS total_pnl,
         avg(net_pnl) AS avg_pnl_per_trade, stddev_pop(net_pnl) AS pnl_stddev
  FROM silver WHERE vol_regime <> 'unknown' GROUP BY vol_regime, symbol)"""

PERF = """perf AS (
  SELECT account_id, tier, vol_regime, symbol, count(*) AS n_trades, sum(net_pnl) AS total_pnl,
         sum(notional) AS gross_notional, sum(fee_amount) AS total_fees
  FROM silver WHERE vol_regime <> 'unknown' GROUP BY account_id, tier, vol_regime, symbol)"""

GOLD_B = """gold_b AS (
  SELECT *,
         dense_rank() OVER (PARTITION BY vol_regime, symbol ORDER BY total_pnl DESC NULLS LAST) AS pnl_rank,
         row_number() OVER (PARTITION BY vol_regime, symbol ORDER BY total_pnl DESC NULLS LAST, account_id ASC NULLS FIRST) AS pnl_row_num,
         sum(total_pnl) OVER (PARTITION BY vol_regime, symbol ORDER BY total_pnl DESC NULLS LAST, account_id ASC NULLS FIRST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_pnl
  FROM perf)"""

GOLD_C = """gold_c AS (
  SELECT trade_date, tier, trend_regime, count(*) AS n_trades, sum(net_pnl) AS total_pnl,
         sum(notional) AS gross_notional
  FROM silver WHERE trend_regime <> 'unknown' GROUP BY trade_date, tier, trend_regime)"""

# Each layer's CTE prerequisites, in order.
_CHAIN = {
    "raw": [RAW],
    "accts": [ACCTS],
    "costed": [RAW, ACCTS, PRICED],
    "bars": [RAW, BARS],
    "trades": [RAW, ACCTS, PRICED, BARS, FWD, TRADES],
    "feat": [RAW, BARS, FEAT],
    "lbars": [RAW, BARS, FEAT, THR, LBARS],
    "silver": [RAW, ACCTS, PRICED, BARS, FWD, TRADES, FEAT, THR, LBARS, SILVER],
}
_CHAIN["gold_a"] = _CHAIN["silver"] + [GOLD_A]
_CHAIN["perf"] = _CHAIN["silver"] + [PERF]
_CHAIN["gold_b"] = _CHAIN["perf"] + [GOLD_B]
_CHAIN["gold_c"] = _CHAIN["silver"] + [GOLD_C]


def with_(layer: str, body: str) -> str:
    return "WITH " + ",\n".join(_CHAIN[layer]) + "\n" + body


SQL: dict[str, str] = {
    "trade_economics": with_("costed", f"""
SELECT trade_id, trade_date, account_id, tier, venue, side, spread_bps, fee_bps,
       {r('fill_price', 6)} AS fill_price, {r('notional', 4)} AS notional, {r('fee_amount', 6)} AS fee_amount
FROM costed"""),
    "round_quantity_bands": with_("trades", f"""
SELECT trade_id, {r('mid_price', 6)} AS mid_price, {r('fill_price', 6)} AS fill_price,
       {r('notional', 4)} AS notional, {r('fee_amount', 6)} AS fee_amount,
       {r('realized_pnl', 6)} AS realized_pnl,
       {r('quantity / mid_price', 8)} AS base_qty,
       CASE WHEN mid_price > 1000e0 THEN {r('quantity / mid_price', 4)}
            WHEN mid_price > 10e0 THEN {r('quantity / mid_price', 2)}
            ELSE {r('quantity / mid_price', 1)} END AS quantity_rounded
FROM trades"""),
    "dimension_lookup": with_("costed", """
SELECT trade_id, account_id, tier, fee_bps,
       CASE tier WHEN 'retail' THEN 500e0 WHEN 'prop' THEN 25000e0 WHEN 'market_maker' THEN 250000e0 END AS base_size
FROM costed"""),
    "accounts_per_tier": with_("accts", """
SELECT tier, count(*) AS n_accounts FROM accts GROUP BY tier"""),
    "mid_lookup": with_("bars", f"""
SELECT r.trade_id, r.symbol, r.mid_price, b.ts_min, {r('b.mid_min', 8)} AS mid_min
FROM raw r LEFT JOIN bars b ON b.symbol = r.symbol AND b.ts_min = date_trunc('minute', r.ts)"""),
    "minute_bars": with_("bars", f"""
SELECT symbol, ts_min, {r('mid_min', 8)} AS mid_min FROM bars"""),
    "bar_features": with_("feat", f"""
SELECT symbol, ts_min, {r('mid_min', 8)} AS mid_min, {r('prev_mid', 8)} AS prev_mid,
       {r('log_return', 8)} AS log_return, {r('sma_20', 8)} AS sma_20,
       {r('sma_60', 8)} AS sma_60, {r('vol_20', 8)} AS vol_20
FROM feat"""),
    "vol_thresholds": with_("feat", f"""
SELECT symbol, {r('quantile_disc(vol_20, 0.33)', 8)} AS vol_lo, {r('quantile_disc(vol_20, 0.66)', 8)} AS vol_hi
FROM feat WHERE vol_20 IS NOT NULL GROUP BY symbol"""),
    "bar_regimes": with_("lbars", f"""
SELECT symbol, ts_min, {r('mid_min', 8)} AS mid_min, {r('vol_20', 8)} AS vol_20,
       {r('sma_20', 8)} AS sma_20, {r('sma_60', 8)} AS sma_60, vol_regime, trend_regime
FROM lbars"""),
    "forward_markout": with_("trades", f"""
SELECT t.trade_id, t.symbol, t.side, {r('t.fill_price', 6)} AS fill_price, t.quantity,
       {r('t.realized_pnl', 4)} AS realized_pnl, f.ts_min, {r('f.fwd_mid', 8)} AS fwd_mid
FROM trades t LEFT JOIN fwd f ON f.symbol = t.symbol AND f.ts_min = date_trunc('minute', t.ts)"""),
    "silver_trades": with_("silver", f"""
SELECT trade_id, ts, account_id, tier, symbol, venue, side, quantity,
       {r('fill_price', 6)} AS fill_price, {r('mid_price', 6)} AS mid_price, {r('notional', 4)} AS notional,
       fee_bps, {r('fee_amount', 6)} AS fee_amount, {r('realized_pnl', 4)} AS realized_pnl, trade_date,
       ts_min, {r('vol_20', 8)} AS vol_20, {r('sma_20', 8)} AS sma_20, {r('sma_60', 8)} AS sma_60,
       vol_regime, trend_regime, {r('net_pnl', 4)} AS net_pnl
FROM silver"""),
    "regime_symbol_rollup": with_("gold_a", f"""
SELECT vol_regime, symbol, n_trades, {r('gross_notional', 2)} AS gross_notional,
       {r('total_fees', 2)} AS total_fees, {r('total_pnl', 2)} AS total_pnl,
       {r('avg_pnl_per_trade', 4)} AS avg_pnl_per_trade, {r('pnl_stddev', 4)} AS pnl_stddev
FROM gold_a"""),
    "account_performance": with_("perf", f"""
SELECT account_id, tier, vol_regime, symbol, n_trades, {r('total_pnl', 2)} AS total_pnl,
       {r('gross_notional', 2)} AS gross_notional, {r('total_fees', 2)} AS total_fees
FROM perf"""),
    "account_ranking": with_("gold_b", f"""
SELECT account_id, tier, vol_regime, symbol, n_trades, {r('total_pnl', 2)} AS total_pnl,
       {r('gross_notional', 2)} AS gross_notional, {r('total_fees', 2)} AS total_fees,
       pnl_rank, pnl_row_num, {r('cumulative_pnl', 2)} AS cumulative_pnl
FROM gold_b"""),
    "day_tier_trend_rollup": with_("gold_c", f"""
SELECT trade_date, tier, trend_regime, n_trades, {r('total_pnl', 2)} AS total_pnl,
       {r('gross_notional', 2)} AS gross_notional
FROM gold_c"""),
    "tier_by_regime": with_("silver", f"""
SELECT tier, vol_regime, count(*) AS n_trades, {r('sum(net_pnl)', 2)} AS total_pnl,
       {r('avg(net_pnl)', 4)} AS avg_pnl, {r('sum(fee_amount)', 2)} AS fees_paid
FROM silver WHERE vol_regime <> 'unknown' GROUP BY tier, vol_regime"""),
    "top5_high_vol": with_("gold_b", f"""
SELECT account_id, tier, symbol, {r('total_pnl', 2)} AS total_pnl, pnl_rank
FROM gold_b WHERE vol_regime = 'high' AND pnl_rank <= 5"""),
    "day_over_day": with_("silver", f"""
, daily AS (
  SELECT trade_date, symbol, sum(net_pnl) AS pnl FROM silver
  WHERE symbol IN ('click', 'view') AND trade_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'
  GROUP BY trade_date, symbol)
SELECT trade_date, symbol, {r('pnl', 2)} AS pnl,
       {r('lag(pnl, 1) OVER (PARTITION BY symbol ORDER BY trade_date)', 2)} AS prev_day_pnl,
       {r('pnl - lag(pnl, 1) OVER (PARTITION BY symbol ORDER BY trade_date)', 2)} AS day_change
FROM daily"""),
    "moving_daily_pnl": with_("silver", f"""
, daily AS (SELECT trade_date, symbol, sum(net_pnl) AS pnl FROM silver GROUP BY trade_date, symbol),
ma AS (
  SELECT trade_date, symbol, pnl,
         avg(pnl) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7
  FROM daily)
SELECT trade_date, symbol, {r('pnl', 2)} AS daily_pnl, {r('ma7', 2)} AS ma7_pnl
FROM ma WHERE symbol = 'click' ORDER BY trade_date LIMIT 15"""),
    "tier_dominance": with_("gold_b", f"""
SELECT tier, count(DISTINCT account_id) AS n_accounts, CAST(sum(n_trades) AS BIGINT) AS n_trades,
       {r('sum(total_pnl)', 2)} AS total_pnl, {r('sum(total_pnl) / sum(n_trades)', 4)} AS pnl_per_trade
FROM gold_b WHERE vol_regime = 'high' GROUP BY tier"""),
    "top3_per_regime_symbol": with_("perf", f"""
, ranked AS (
  SELECT account_id, tier, vol_regime, symbol, total_pnl,
         dense_rank() OVER (PARTITION BY vol_regime, symbol ORDER BY total_pnl DESC NULLS LAST) AS pnl_rank
  FROM perf)
SELECT account_id, tier, vol_regime, symbol, {r('total_pnl', 2)} AS total_pnl, pnl_rank
FROM ranked WHERE pnl_rank <= 3"""),
    "top10_one_symbol": with_("gold_b", f"""
SELECT account_id, tier, vol_regime, symbol, n_trades, {r('total_pnl', 2)} AS total_pnl, pnl_rank, pnl_row_num
FROM gold_b WHERE vol_regime = 'high' AND symbol = 'click'
ORDER BY pnl_rank, account_id LIMIT 10"""),
    "regime_share": with_("silver", f"""
, c AS (SELECT vol_regime, count(*) AS n_trades FROM silver WHERE vol_regime <> 'unknown' GROUP BY vol_regime)
SELECT vol_regime, n_trades, {r('n_trades / sum(n_trades) OVER ()', 8)} AS share FROM c"""),
    "pnl_pivot": with_("gold_a", f"""
SELECT symbol,
       {r("coalesce(sum(total_pnl) FILTER (WHERE vol_regime = 'low'), 0e0)", 2)} AS low,
       {r("coalesce(sum(total_pnl) FILTER (WHERE vol_regime = 'medium'), 0e0)", 2)} AS medium,
       {r("coalesce(sum(total_pnl) FILTER (WHERE vol_regime = 'high'), 0e0)", 2)} AS high
FROM gold_a GROUP BY symbol"""),
    "daily_tier_pivot": with_("gold_c", f"""
SELECT trade_date,
       {r("coalesce(sum(total_pnl) FILTER (WHERE tier = 'retail'), 0e0)", 2)} AS retail,
       {r("coalesce(sum(total_pnl) FILTER (WHERE tier = 'prop'), 0e0)", 2)} AS prop,
       {r("coalesce(sum(total_pnl) FILTER (WHERE tier = 'market_maker'), 0e0)", 2)} AS market_maker
FROM gold_c GROUP BY trade_date"""),
    "cumulative_tier_pnl": with_("gold_c", f"""
, days AS (SELECT DISTINCT trade_date FROM gold_c),
tiers AS (SELECT * FROM (VALUES ('retail'), ('prop'), ('market_maker')) v(tier)),
cell AS (
  SELECT d.trade_date, t.tier,
         coalesce((SELECT sum(g.total_pnl) FROM gold_c g WHERE g.trade_date = d.trade_date AND g.tier = t.tier), 0e0) AS pnl
  FROM days d, tiers t)
SELECT trade_date, tier, {r('pnl', 2)} AS pnl,
       {r('sum(pnl) OVER (PARTITION BY tier ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS cumulative_pnl
FROM cell"""),
    "counts_by_day": with_("trades", """
SELECT trade_date, count(*) AS n_trades, count(DISTINCT account_id) AS n_accounts
FROM trades GROUP BY trade_date"""),
    "expectation_report": with_("trades", """
, checks AS (
  SELECT
    coalesce(trade_id IS NOT NULL AND account_id IS NOT NULL, false) AS ids_present,
    coalesce(ts IS NOT NULL AND trade_date IS NOT NULL, false) AS has_time,
    coalesce(trade_date = CAST(ts AS DATE), false) AS date_is_day_of_time,
    coalesce(side IN ('BUY', 'SELL'), false) AS known_side,
    coalesce(quantity > 0, false) AS positive_quantity,
    coalesce(mid_price > 0 AND fill_price > 0, false) AS positive_prices,
    coalesce(abs(notional - fill_price * quantity) <= 1e-6 * abs(fill_price * quantity) + 1e-4, false)
      AS notional_is_fill_times_quantity,
    coalesce(abs(fee_amount - notional * fee_bps / 10000e0) <= 1e-6 * abs(notional * fee_bps / 10000e0) + 1e-6, false)
      AS fee_matches_schedule
  FROM trades)
SELECT 'ids_present' AS rule, count(*) FILTER (WHERE NOT ids_present) AS n_failed FROM checks
UNION ALL SELECT 'has_time', count(*) FILTER (WHERE NOT has_time) FROM checks
UNION ALL SELECT 'date_is_day_of_time', count(*) FILTER (WHERE NOT date_is_day_of_time) FROM checks
UNION ALL SELECT 'known_side', count(*) FILTER (WHERE NOT known_side) FROM checks
UNION ALL SELECT 'positive_quantity', count(*) FILTER (WHERE NOT positive_quantity) FROM checks
UNION ALL SELECT 'positive_prices', count(*) FILTER (WHERE NOT positive_prices) FROM checks
UNION ALL SELECT 'notional_is_fill_times_quantity', count(*) FILTER (WHERE NOT notional_is_fill_times_quantity) FROM checks
UNION ALL SELECT 'fee_matches_schedule', count(*) FILTER (WHERE NOT fee_matches_schedule) FROM checks"""),
    "null_safe_labels": with_("silver", """
SELECT vol_regime, trend_regime, count(*) AS n_trades,
       count(*) FILTER (WHERE vol_20 IS NULL) AS n_null_vol,
       count(*) FILTER (WHERE vol_regime <> 'unknown') AS n_in_vol_gold,
       count(*) FILTER (WHERE trend_regime <> 'unknown') AS n_in_trend_gold
FROM silver GROUP BY vol_regime, trend_regime"""),
}
# the same rows from a colocated store, from merged blocks and from merged days
SQL["silver_colocated"] = SQL["silver_trades"]
SQL["vol_thresholds_merged"] = SQL["vol_thresholds"]
SQL["regime_symbol_merged"] = SQL["regime_symbol_rollup"]
SQL["account_performance_merged"] = SQL["account_performance"]
SQL["account_ranking_indexed"] = SQL["account_ranking"]
SQL["distinct_accounts_range"] = with_("silver", """
SELECT tier, vol_regime, count(DISTINCT account_id) AS n_accounts FROM silver
WHERE trade_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-20' GROUP BY tier, vol_regime""")
