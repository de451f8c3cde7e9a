"""Analyst access to the stored layers written by ``plans.job``.

``Warehouse(spark, root)`` reads each layer with its declared schema and can
register the SQL views analysts query (S3): ``trades`` (silver),
``agg_vol`` (gold A), ``acct_rank`` (gold B) and ``daily_tier`` (gold C).
Filters on ``trade_date`` / ``symbol`` / ``vol_regime`` prune directories.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tradeflow.plans.job import Layout
from tradeflow.schema import (
    ACCOUNT_RANKING_SCHEMA,
    DAY_TIER_TREND_SCHEMA,
    REGIME_ROLLUP_SCHEMA,
    SILVER_SCHEMA,
)
from tradeflow.sources import read_layer, register


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.layout = Layout(root)

    @cached_property
    def silver(self) -> DataFrame:
        return read_layer(self.spark, self.layout.silver, SILVER_SCHEMA)

    @cached_property
    def gold_a(self) -> DataFrame:
        return read_layer(self.spark, self.layout.gold_regime, REGIME_ROLLUP_SCHEMA)

    @cached_property
    def gold_b(self) -> DataFrame:
        return read_layer(self.spark, self.layout.gold_ranking, ACCOUNT_RANKING_SCHEMA)

    @cached_property
    def gold_c(self) -> DataFrame:
        return read_layer(self.spark, self.layout.gold_daily, DAY_TIER_TREND_SCHEMA)

    def register_views(self) -> None:
        register(self.silver, "trades")
        register(self.gold_a, "agg_vol")
        register(self.gold_b, "acct_rank")
        register(self.gold_c, "daily_tier")
