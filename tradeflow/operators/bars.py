"""Minute bars and rolling bar features.

Bars are the pre-aggregate every time-series step runs on: one row per
(symbol, minute) however many trades fall in it, so the windows below never
see trade volume.

Rolling frames count *rows* (missing minutes are skipped, D6).  The plain
form orders each symbol in one window partition.  The default chunked form
keeps the same answer while bounding every window partition:

1. number the bars of each symbol 0..n-1 (per-day counts -> running offsets
   over a days-per-symbol table -> row_number inside each (symbol, day));
2. cut the numbering into blocks of ``chunk_rows`` bars;
3. copy the last ``lookback`` bars of every block into the next block as
   context rows, window over (symbol, block), and drop the context rows.

``lookback = max(slow - 1, fast)`` rows of history is all any frame reads
(the 20-row volatility of returns needs 20 returns, i.e. 21 mids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import epoch_seconds, minute_of, ratio_log

DAY_SECONDS = 86400
# stands in for the day of a bar without a minute: before any day
NO_DAY = -(1 << 40)
DEFAULT_CHUNK_ROWS = 100_000


def minute_bars(trades: DataFrame, price: str = "mid_price", ts: str = "ts") -> DataFrame:
    """A1: average mid per (symbol, minute) -> symbol, ts_min, mid_min.

    A partial aggregate runs before the shuffle, so a hot symbol or minute is
    reduced map-side to one row per task.
    """
    return (
        trades.select("symbol", minute_of(ts).alias("ts_min"), F.col(price).alias("_px"))
        .groupBy("symbol", "ts_min")
        .agg(F.avg("_px").alias("mid_min"))
    )


def rolling_features(df: DataFrame, part_cols: list[str], order_col: str, fast: int = 20,
                     slow: int = 60) -> DataFrame:
    """The W1-W4 window columns over ``df`` partitioned by ``part_cols``.

    Every function shares one (partition, order) specification, so Spark runs
    them over a single sort; ``order_col`` must be an existing column for
    other windows on the same order to reuse that sort too.
    """
    w = Window.partitionBy(*part_cols).orderBy(order_col)
    w_fast = w.rowsBetween(-(fast - 1), 0)
    w_slow = w.rowsBetween(-(slow - 1), 0)
    return (
        df.withColumn("prev_mid", F.lag("mid_min", 1).over(w))
        .withColumn("log_return", ratio_log("mid_min", "prev_mid"))
        .withColumns({
            f"sma_{fast}": F.avg("mid_min").over(w_fast),
            f"sma_{slow}": F.avg("mid_min").over(w_slow),
            f"vol_{fast}": F.stddev_pop("log_return").over(w_fast),
        })
    )


def bar_ordinals(bars: DataFrame, block_seconds: int = DAY_SECONDS) -> DataFrame:
    """Add ``_idx``: the 0-based position of each bar in its symbol's time order.

    Only a (symbol, day) count table is ever ordered per symbol; the bars
    themselves are numbered inside (symbol, day) groups of at most 1,440 rows.
    A NULL symbol is a series of its own and a NULL minute its first bar: both
    are numbered through non-null stand-ins, so that the offsets join is a
    plain equality on the numbering window's own partitioning.
    """
    day = F.coalesce(F.floor(epoch_seconds("ts_min") / F.lit(block_seconds)), F.lit(NO_DAY))
    keys = ["_known", "_symbol", "_day"]
    staged = bars.withColumns({"_known": F.col("symbol").isNotNull(), "_symbol": F.coalesce("symbol", F.lit("")), "_day": day})
    counts = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    w_days = Window.partitionBy("_known", "_symbol").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(w_days), F.lit(0)).alias("_offset"))
    w_in_day = Window.partitionBy(*keys).orderBy("ts_min")
    return (
        staged.withColumn("_row", F.row_number().over(w_in_day))
        .join(offsets, on=keys, how="inner")
        .withColumn("_idx", F.col("_offset") + F.col("_row") - 1)
        .drop(*keys, "_offset", "_row")
    )


def bar_features(bars: DataFrame, fast: int = 20, slow: int = 60,
                 chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """prev_mid, log_return, sma_{fast}, sma_{slow}, vol_{fast}.

    The chunked exact form (see module docstring) at every size;
    ``chunk_rows=None`` is the plain per-symbol window it must equal.  Other
    columns of ``bars`` are passed through.
    """
    if chunk_rows is None:
        return rolling_features(bars, ["symbol"], "ts_min", fast, slow)
    lookback = max(slow - 1, fast)
    if chunk_rows < lookback:
        raise ValueError("chunk_rows must be at least the look-back")
    block = F.lit(int(chunk_rows))
    numbered = bar_ordinals(bars).withColumn("_block", F.floor(F.col("_idx") / block))
    is_tail = F.pmod(F.col("_idx"), block) >= F.lit(int(chunk_rows) - lookback)
    staged = numbered.withColumn(
        "_part",
        F.explode(F.when(is_tail, F.array(F.col("_block"), F.col("_block") + 1))
                  .otherwise(F.array(F.col("_block")))),
    )
    return (
        rolling_features(staged, ["symbol", "_part"], "_idx", fast, slow)
        .filter(F.col("_part") == F.col("_block"))
        .drop("_idx", "_block", "_part")
    )
