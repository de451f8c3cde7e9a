"""SQL users query the stored layers through views with the layer column names."""

from __future__ import annotations

import os

from tradeflow.operators import pnl_by_tier_regime, tier_dominance
from tradeflow.plans.job import run_job
from tradeflow.warehouse import Warehouse
from tests.conftest import SF0001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_views_answer_sql_like_the_operators(spark, scratch_dir):
    root = os.path.join(scratch_dir, "wh")
    run_job(spark, root, events_dir=SF0001)
    wh = Warehouse(spark, root)
    wh.register_views()
    by_sql = spark.sql("""
        SELECT tier, vol_regime, COUNT(*) AS n_trades,
               CAST(ROUND(CAST(SUM(net_pnl) AS DECIMAL(38,18)), 2) AS DOUBLE) AS total_pnl,
               CAST(ROUND(CAST(AVG(net_pnl) AS DECIMAL(38,18)), 4) AS DOUBLE) AS avg_pnl,
               CAST(ROUND(CAST(SUM(fee_amount) AS DECIMAL(38,18)), 2) AS DOUBLE) AS fees_paid
        FROM trades WHERE vol_regime != 'unknown' GROUP BY tier, vol_regime""")
    assert _rows(by_sql) == _rows(pnl_by_tier_regime(wh.silver))
    # string date bounds compare against the DATE partition column and prune
    window = spark.sql("SELECT COUNT(*) FROM trades WHERE trade_date BETWEEN '2024-01-15' AND '2024-01-20'")
    assert window.first()[0] == wh.silver.filter("trade_date >= DATE'2024-01-15' AND trade_date <= DATE'2024-01-20'").count()
    dom = spark.sql("""
        SELECT tier, COUNT(DISTINCT account_id) AS n_accounts, SUM(n_trades) AS n_trades
        FROM acct_rank WHERE vol_regime = 'high' GROUP BY tier""")
    expect = tier_dominance(wh.gold_b, "high").select("tier", "n_accounts", "n_trades")
    assert _rows(dom) == _rows(expect)
    assert spark.sql("SELECT COUNT(*) FROM agg_vol").first()[0] == wh.gold_a.count()
    assert spark.sql("SELECT COUNT(*) FROM daily_tier").first()[0] == wh.gold_c.count()
