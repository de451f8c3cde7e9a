"""DataFrame -> DataFrame operators (compose with ``df.transform``)."""

from tradeflow.operators.bars import bar_features, bar_ordinals, minute_bars
from tradeflow.operators.economics import (
    attach_account,
    priced_trades,
    round_quantity,
    storage_precision,
    with_costs,
    with_fee_schedule,
    with_fill_price,
    with_markout_pnl,
    with_spread,
)
from tradeflow.operators.markout import forward_mid
from tradeflow.operators.ranking import leading_accounts, rank_accounts, top_accounts, top_in_regime, top_n_per_group
from tradeflow.operators.regimes import (
    attach_labels,
    label_bars,
    labelled_bars,
    silver_trades,
    vol_thresholds,
)
from tradeflow.operators.reports import daily_tier_pivot, pnl_pivot
from tradeflow.operators.rollups import (
    account_performance,
    counts_by,
    daily_symbol_pnl,
    labelled,
    pnl_by_tier_regime,
    regime_share,
    rollup_day_tier_trend,
    rollup_regime_symbol,
    tier_dominance,
)
from tradeflow.operators.timeline import cumulative_tier_pnl, day_over_day, moving_daily_pnl

__all__ = [name for name in dir() if not name.startswith("_")]
