"""The layered job by delta: a late file rebuilds the days it touches.

``build_increments`` stores, beside the layers of the full job, what merges by
day: volatility blocks (thresholds), daily roll-ups (gold), account numbers and
bitmaps (distinct accounts).  ``refresh`` then takes a late file:

1. bronze: upsert; ``touched`` are the days whose trades change;
2. bars of the touched days; features of the touched days and of the days whose
   first bars look back into them, from those days' bars and their context;
3. blocks of these days; thresholds merged from all blocks;
4. silver and daily roll-ups of these days - and, for symbols whose thresholds
   changed, of all their days, because every label of theirs may change;
5. gold, merged from the daily roll-ups.

Every layer equals the one a full rebuild gives.  Days reach the driver as a
list of dates, which names the partitions to read and to replace.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.operators import attach_labels, bar_features, label_bars, minute_bars, rank_accounts
from tradeflow.operators.bitmaps import account_bitmaps, number_accounts
from tradeflow.operators.daily import daily_rollups, gold_a_from_daily, gold_c_from_daily, performance_from_daily
from tradeflow.operators.vol_blocks import thresholds_from_blocks, vol_blocks
from tradeflow.plans.job import JobReport, Layout, clear_staging, stage_trades, upsert_bronze, write_bars
from tradeflow.plans.lineage import join_null_safe, materialize
from tradeflow.schema import BAR_LAYER_SCHEMA, BRONZE_SCHEMA, FEATURE_SCHEMA, SILVER_SCHEMA
from tradeflow.sinks import write_layer
from tradeflow.sinks.files import partition_folder, remove_partitions
from tradeflow.sources import read_layer

#: bars of history that any feature reads
LOOKBACK = 60

Days = Sequence[datetime.date]

BLOCK_SCHEMA = "symbol string, block int, n long, lo double, hi double, values array<double>, trade_date date"
THRESHOLD_SCHEMA = "symbol string, vol_lo double, vol_hi double"
NUMBER_SCHEMA = "account_id string, number long"
BITMAP_SCHEMA = "tier string, vol_regime string, bucket long, accounts binary, trade_date date"


class IncrementLayout:
    """Where the increments lie under the job's root."""

    def __init__(self, layout: Layout):
        at = f"{layout.root.rstrip('/')}/warehouse/increments"
        self.blocks, self.daily, self.bitmaps = f"{at}/vol_blocks", f"{at}/daily_rollups", f"{at}/account_bitmaps"
        self.staging = layout.staging
        self._versions = {"thresholds": f"{at}/thresholds", "numbers": f"{at}/account_numbers"}

    def replace(self, df: DataFrame, name: str) -> None:
        """Store a small table that the same run may have read: staged before it is overwritten."""
        materialize(df, name, self.staging).write.mode("overwrite").parquet(self._versions[name])

    def read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(self._versions[name])


def on_days(days: Days) -> Column:
    """A filter on the partition column that names the days."""
    return F.col("trade_date").isin([F.lit(d) for d in days]) if days else F.lit(False)


def _stored_days(df: DataFrame) -> set[datetime.date]:
    return {r["trade_date"] for r in df.select("trade_date").distinct().collect()}


def _replace_days(df: DataFrame, path: str, days: Iterable[datetime.date], sort_by: Sequence[str], layout: Layout) -> None:
    """Replace ``days`` of a layer by ``df``'s; days that ``df`` does not hold are removed."""
    staged = materialize(df, "days", layout.staging)
    write_layer(staged, path, ["trade_date"], sort_by=sort_by, dynamic=True)
    gone = set(days) - _stored_days(staged)
    remove_partitions(df.sparkSession, path, [f"trade_date={d}" for d in sorted(gone)])


def days_within(bars: DataFrame, days: Days, lookback: int = LOOKBACK, after: bool = True) -> list[datetime.date]:
    """The days with bars fewer than ``lookback`` bars (of any symbol) after ``days``, or before them.

    Reads symbols and days only; the windows run over one row for each symbol and day.
    """
    counts = bars.groupBy("symbol", "trade_date").agg(F.count(F.lit(1)).alias("n"))
    # the given days, for every symbol
    marks = bars.select("symbol").distinct().select(
        "symbol", F.explode(F.array(*[F.lit(d) for d in days])).alias("trade_date"), F.lit(0).cast("long").alias("n"))
    timeline = counts.unionByName(marks).groupBy("symbol", "trade_date").agg(F.sum("n").alias("n")).withColumn("given", on_days(days))
    day = F.col("trade_date").asc() if after else F.col("trade_date").desc()
    order = Window.partitionBy("symbol").orderBy(day)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    timeline = timeline.withColumns({"upto": upto, "ahead": F.coalesce(F.sum("n").over(before), F.lit(0))})
    last = F.last(F.when(F.col("given"), F.col("upto")), ignorenulls=True).over(before)
    near = timeline.withColumn("last", last).filter((F.col("n") > 0) & (F.col("ahead") - F.col("last") < lookback))
    return sorted(_stored_days(near))


def build_increments(spark: SparkSession, layout: Layout) -> None:
    """The mergeable layers of a warehouse that the full job has built."""
    own = IncrementLayout(layout)
    write_layer(vol_blocks(read_layer(spark, layout.features, FEATURE_SCHEMA)), own.blocks, ["trade_date"], sort_by=["lo"])
    own.replace(thresholds_from_blocks(spark.read.schema(BLOCK_SCHEMA).parquet(own.blocks)), "thresholds")
    silver = read_layer(spark, layout.silver, SILVER_SCHEMA)
    write_layer(daily_rollups(silver), own.daily, ["trade_date"], sort_by=["rollup"])
    own.replace(number_accounts(silver), "numbers")
    write_layer(account_bitmaps(silver, own.read(spark, "numbers", NUMBER_SCHEMA)), own.bitmaps, ["trade_date"], sort_by=["tier"])


def refresh_bars(spark: SparkSession, layout: Layout, touched: Days) -> list[datetime.date]:
    """Bars and features after a change of the touched days; the days whose features changed."""
    bronze = read_layer(spark, layout.bronze, BRONZE_SCHEMA).filter(on_days(touched))
    bars = minute_bars(bronze).withColumn("trade_date", F.to_date("ts_min"))
    _replace_days(bars, layout.bars, touched, ["symbol", "ts_min"], layout)
    stored = read_layer(spark, layout.bars, BAR_LAYER_SCHEMA)
    following = days_within(stored.select("symbol", "trade_date"), touched)
    changed = sorted({*touched, *following})
    context = days_within(stored.select("symbol", "trade_date"), changed, after=False)
    read = stored.filter(on_days(sorted({*changed, *context})))
    features = bar_features(materialize(read, "bars", layout.staging)).filter(on_days(changed))
    _replace_days(features, layout.features, changed, ["symbol", "ts_min"], layout)
    return changed


def refresh_thresholds(spark: SparkSession, layout: Layout, changed: Days) -> list[str | None]:
    """Blocks of the changed days, thresholds merged from all; the symbols whose thresholds changed."""
    own = IncrementLayout(layout)
    features = read_layer(spark, layout.features, FEATURE_SCHEMA).filter(on_days(changed))
    _replace_days(vol_blocks(features), own.blocks, changed, ["lo"], layout)
    before = own.read(spark, "thresholds", THRESHOLD_SCHEMA)
    after = materialize(thresholds_from_blocks(spark.read.schema(BLOCK_SCHEMA).parquet(own.blocks)), "thresholds", layout.staging)
    # a symbol is the unit of a price series: a list of names
    moved = after.exceptAll(before).select("symbol").unionByName(before.exceptAll(after).select("symbol")).distinct().collect()
    own.replace(after, "thresholds")
    return [r["symbol"] for r in moved]


def refresh_silver(spark: SparkSession, layout: Layout, changed: Days, symbols: Sequence[str | None]) -> list[datetime.date]:
    """Silver of the changed days, and of all days of ``symbols``; the days whose silver changed."""
    own = IncrementLayout(layout)
    bronze, features = read_layer(spark, layout.bronze, BRONZE_SCHEMA), read_layer(spark, layout.features, FEATURE_SCHEMA)
    mine = on_days(changed)
    for symbol in symbols:
        mine = mine | F.col("symbol").eqNullSafe(F.lit(symbol))
    trades = bronze.filter(mine)
    bars = label_bars(features.filter(mine).drop("trade_date"), own.read(spark, "thresholds", THRESHOLD_SCHEMA))
    stored = read_layer(spark, layout.silver, SILVER_SCHEMA).filter(mine).select("trade_date", "symbol").distinct().collect()
    staged = materialize(attach_labels(trades, bars).select(*SILVER_SCHEMA.fieldNames()), "silver", layout.staging)
    held = {(r["trade_date"], r["symbol"]) for r in staged.select("trade_date", "symbol").distinct().collect()}
    write_layer(staged, layout.silver, ["trade_date", "symbol"], sort_by=["ts"], dynamic=True)
    gone = {(r["trade_date"], r["symbol"]) for r in stored} - held
    remove_partitions(spark, layout.silver, [
        partition_folder(spark, trade_date=d, symbol=s) for d, s in sorted(gone, key=str)])
    return sorted({*changed, *(d for d, _ in held), *(d for d, _ in gone)})


def refresh_daily(spark: SparkSession, layout: Layout, days: Days) -> None:
    """Roll-ups and account bitmaps of ``days``, from their silver alone."""
    own = IncrementLayout(layout)
    silver = read_layer(spark, layout.silver, SILVER_SCHEMA).filter(on_days(days))
    _replace_days(daily_rollups(silver), own.daily, days, ["rollup"], layout)
    own.replace(number_accounts(silver, own.read(spark, "numbers", NUMBER_SCHEMA)), "numbers")
    _replace_days(account_bitmaps(silver, own.read(spark, "numbers", NUMBER_SCHEMA)), own.bitmaps, days, ["tier"], layout)


def read_daily(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.parquet(IncrementLayout(layout).daily).withColumn("trade_date", F.col("trade_date").cast("date"))


def read_bitmaps(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(BITMAP_SCHEMA).parquet(IncrementLayout(layout).bitmaps)


def merge_gold(spark: SparkSession, layout: Layout) -> None:
    """The three gold tables from the daily roll-ups; no trade is read."""
    daily = read_daily(spark, layout)
    write_layer(gold_a_from_daily(daily), layout.gold_regime, ["vol_regime"])
    write_layer(rank_accounts(performance_from_daily(daily)), layout.gold_ranking, ["vol_regime", "symbol"])
    write_layer(gold_c_from_daily(daily), layout.gold_daily, ["trade_date"])


def refresh_days(spark: SparkSession, layout: Layout, touched: Days) -> dict[str, int]:
    """All layers below bronze after a change of the touched days; how much was rebuilt."""
    if not touched:
        return {}
    changed = refresh_bars(spark, layout, touched)
    symbols = refresh_thresholds(spark, layout, changed)
    days = refresh_silver(spark, layout, changed, symbols)
    refresh_daily(spark, layout, days)
    merge_gold(spark, layout)
    return {"changed_days": len(changed), "moved_thresholds": len(symbols), "silver_days": len(days)}


def refresh(spark: SparkSession, root: str, late_csv: str, report: JobReport | None = None) -> JobReport:
    """A late CSV into a warehouse that has its increments (``build_increments``)."""
    layout, report = Layout(root), report or JobReport()
    staged = stage_trades(spark, layout, late_csv)
    touched = upsert_bronze(spark, layout, staged["good"])
    staged["failed"].write.mode("append").parquet(layout.quarantine_expectations)
    staged["bad"].write.mode("append").parquet(layout.quarantine)
    report.counts.update({"late": staged["n"].get("good", 0), "touched_days": len(touched)})
    report.counts.update(refresh_days(spark, layout, touched))
    clear_staging(spark, layout)
    return report
