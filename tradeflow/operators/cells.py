"""Cells: the unit in which trades and the bars they need are stored side by side.

A cell is one symbol's trades of one day, or a share of them: a (symbol, day)
of more than ``cell_rows`` trades is cut into slots by the hash of the minute,
so a trade and its minute bar fall into the same slot, and a single minute of
more than that is dealt to several copies by the hash of the trade, each of
which gets the bar.  A 64-bit name stands for (symbol, day, slot, copy); equal
names of different cells do no harm, because the join compares symbol and
minute as well.

The split table lists only the (symbol, day) groups that are cut: at most one
row for every ``cell_rows`` trades, with at most 1,440 minutes in it.  It is
joined without a hint, so AQE broadcasts it where it measures small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import minute_of
from tradeflow.plans.lineage import join_null_safe

CELL_ROWS = 1_000_000
CELL = "cell"


def counted_bars(trades: DataFrame, price: str = "mid_price", ts: str = "ts") -> DataFrame:
    """A1 with the number of trades behind each bar: symbol, ts_min, mid_min, n_trades."""
    return trades.select("symbol", minute_of(ts).alias("ts_min"), F.col(price).alias("_px")).groupBy("symbol", "ts_min").agg(
        F.avg("_px").alias("mid_min"), F.count(F.lit(1)).alias("n_trades"))


def split_table(bars: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(symbol, day, slots, copies) of the groups that are cut; ``copies`` maps their hot minutes to a number of copies."""
    shares = F.ceil(F.col("n_trades") / F.lit(cell_rows)).cast("int")
    hot = F.when(shares > 1, F.struct(F.col("ts_min"), shares))
    days = bars.groupBy("symbol", F.to_date("ts_min").alias("day")).agg(
        F.ceil(F.sum("n_trades") / F.lit(cell_rows)).cast("int").alias("slots"),
        # at most the minutes of a day
        F.map_from_entries(F.collect_list(F.when(F.col("ts_min").isNotNull(), hot))).alias("copies"))
    return days.filter(F.col("slots") > 1)


def _named(df: DataFrame, splits: DataFrame, minute: str, copy) -> DataFrame:
    """``df`` with its cell; ``copy(copies)`` adds the column ``_copy``."""
    split = join_null_safe(df.withColumn("_day", F.to_date(minute)), splits.withColumnRenamed("day", "_day"), ["symbol", "_day"], "left")
    copies = F.coalesce(F.element_at("copies", F.col(minute)), F.lit(1))
    dealt = copy(split, copies).withColumn("_slot", F.pmod(F.xxhash64(minute), F.coalesce("slots", F.lit(1))))
    return dealt.withColumn(CELL, F.xxhash64("symbol", "_day", "_slot", "_copy")).drop("slots", "copies", "_day", "_slot", "_copy")


def trades_with_cell(trades: DataFrame, splits: DataFrame, key: str = "trade_id", ts: str = "ts") -> DataFrame:
    """The trades with their cell; a hot minute's trades are dealt by ``key``."""
    own = trades.withColumn("_minute", minute_of(ts))
    return _named(own, splits, "_minute", lambda df, copies: df.withColumn(
        "_copy", F.pmod(F.xxhash64(key), copies).cast("int"))).drop("_minute")


def bars_with_cell(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """The bars with their cell, one row for each copy of a hot minute."""
    return _named(bars, splits, "ts_min", lambda df, copies: df.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1))))
