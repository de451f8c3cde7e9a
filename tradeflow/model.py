"""The trade model over the driver tables, as lazily built DataFrames.

``TradeModel(spark, sf_dir)`` wires the operators into the reference's
layers - trades (bronze), labelled bars, silver, gold A/B/C.  Each attribute
is a plan that Catalyst optimises together with whatever query reads it,
except three results that several branches read: the minute bars, the bar
features and the ranking's input are computed once into the shared checkpoint
folder (``plans.lineage``).  The same plans run at every size.  A query that
reads a few symbols says so (``symbols``): a symbol's series does not depend
on the others, so the filter sits below everything that is stored.  The batch
job (``plans.job``) runs the same chain but stores every layer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.operators import (
    account_performance,
    label_bars,
    minute_bars,
    rank_accounts,
    rollup_day_tier_trend,
    rollup_regime_symbol,
    vol_thresholds,
)
from tradeflow.operators.bars import DEFAULT_CHUNK_ROWS, bar_features
from tradeflow.operators.economics import priced_labelled_trades, priced_trades
from tradeflow.operators.markout import forward_mid
from tradeflow.plans.lineage import materialize
from tradeflow.sources.fixtures import account_book_from_events, trades_raw_from_events


class TradeModel:
    def __init__(self, spark: SparkSession, sf_dir: str, symbols: Sequence[str] | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.symbols = symbols
        self.chunk_rows = chunk_rows

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        events = self.table("events")
        return events if self.symbols is None else events.filter(F.col("event_type").isin(*self.symbols))

    @cached_property
    def raw(self) -> DataFrame:
        return trades_raw_from_events(self.events)

    @cached_property
    def accounts(self) -> DataFrame:
        return account_book_from_events(self.events)

    @cached_property
    def flow(self) -> DataFrame:
        # the order flow with its account tier, as the trades file carries it
        return trades_raw_from_events(self.events, with_tier=True)

    @cached_property
    def bars(self) -> DataFrame:
        return minute_bars(self.raw)

    @cached_property
    def trades(self) -> DataFrame:
        return priced_trades(self.flow, None, bars=self.bars)

    @cached_property
    def features(self) -> DataFrame:
        # numbering reads the bars twice: one pass over the trade flow stores them
        return bar_features(materialize(self.bars, "minute_bars"), chunk_rows=self.chunk_rows)

    @cached_property
    def _stored_features(self) -> DataFrame:
        # read by the thresholds (twice), by the labels and by the forward mid
        return materialize(self.features, "bar_features")

    @cached_property
    def thresholds(self) -> DataFrame:
        return vol_thresholds(self._stored_features)

    @cached_property
    def bar_attrs(self) -> DataFrame:
        """Labels and forward mid of every bar; a query that reads no PnL computes no forward mid."""
        return label_bars(forward_mid(self._stored_features), self.thresholds)

    @cached_property
    def labelled_bars(self) -> DataFrame:
        return label_bars(self._stored_features, self.thresholds)

    @cached_property
    def silver(self) -> DataFrame:
        # One join of the trade flow with the bar table (labels + forward mid);
        # equal to attaching labels to the priced trades.
        return priced_labelled_trades(self.flow, None, self.bar_attrs)

    @cached_property
    def gold_a(self) -> DataFrame:
        return rollup_regime_symbol(self.silver)

    @cached_property
    def perf(self) -> DataFrame:
        return account_performance(self.silver)

    @cached_property
    def gold_b(self) -> DataFrame:
        return rank_accounts(self.perf)

    @cached_property
    def gold_c(self) -> DataFrame:
        return rollup_day_tier_trend(self.silver)
