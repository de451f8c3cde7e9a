"""Thresholds that can be refreshed (A9): a mergeable rank summary per (symbol, day).

A day's volatilities of a symbol are sorted once (at most 1,440 values) and cut
into blocks of ``block_values``: number of values, least, greatest, and the
values themselves.  Blocks of all days merge without reading values.  For any
value ``v``, the blocks that end at or below ``v`` hold at least, and those that
begin at or below ``v`` at most the values up to ``v``; so the value of rank
``k`` lies between the least block begin where the second count reaches ``k``
and the least block end where the first does.  Blocks below that bracket count
as a whole, blocks above it are left out, and only the values of the blocks
that overlap it are read and counted to find rank ``k``: the exact discrete
quantile, as ``vol_thresholds`` gives it.

A new or changed day replaces its own blocks; no other day's bars are needed.
NULL symbols and days are groups of their own; NULL volatilities have no rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.operators.regimes import VOL_PROBS
from tradeflow.plans.lineage import join_null_safe, materialize

BLOCK_VALUES = 32


def vol_blocks(features: DataFrame, vol: str = "vol_20", block_values: int = BLOCK_VALUES) -> DataFrame:
    """(symbol, trade_date, block, n, lo, hi, values) of features with their day."""
    day = Window.partitionBy("symbol", "trade_date").orderBy(vol)
    ranked = features.filter(F.col(vol).isNotNull()).select("symbol", "trade_date", F.col(vol).alias("v"), (
        F.floor((F.row_number().over(day) - 1) / F.lit(block_values))).cast("int").alias("block"))
    return ranked.groupBy("symbol", "trade_date", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.sort_array(F.collect_list("v")).alias("values"))


def _reached(blocks: DataFrame, targets: DataFrame, end: str, name: str) -> DataFrame:
    """(symbol, q, name): the least ``end`` at which the blocks counted by it hold rank ``k``."""
    steps = blocks.groupBy("symbol", F.col(end).alias("v")).agg(F.sum("n").alias("n"))
    # a row for each distinct block end of a symbol, whatever the number of trades
    upto = Window.partitionBy("symbol").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = steps.withColumn("upto", F.sum("n").over(upto))
    return join_null_safe(counted, targets, ["symbol"]).filter("upto >= k").groupBy("symbol", "q").agg(F.min("v").alias(name))


def rank_brackets(blocks: DataFrame, probs: Sequence[float] = VOL_PROBS) -> DataFrame:
    """(symbol, q, k, from, to): where the value of rank ``k`` lies, without reading a value."""
    totals = blocks.groupBy("symbol").agg(F.sum("n").alias("total"))
    targets = totals.select("symbol", "total", F.explode(F.array(*[F.lit(p) for p in probs])).alias("q")).select(
        "symbol", "q", F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("total"))).alias("k"))
    low, high = _reached(blocks, targets, "lo", "from"), _reached(blocks, targets, "hi", "to")
    return join_null_safe(join_null_safe(targets, low, ["symbol", "q"]), high, ["symbol", "q"])


def overlapping_blocks(blocks: DataFrame, brackets: DataFrame) -> DataFrame:
    """(symbol, q, k, from, values) of the blocks that a bracket overlaps.

    The widest bracket of each quantile goes to the scan as literals, where row
    groups and pages outside it are skipped.
    """
    wanted = F.lit(False)
    for b in brackets.groupBy("q").agg(F.min("from").alias("a"), F.max("to").alias("b")).collect():  # a row for each quantile
        wanted = wanted | ((F.col("hi") >= b["a"]) & (F.col("lo") <= b["b"]))
    return join_null_safe(blocks.filter(wanted).select("symbol", "lo", "hi", "values"), brackets, ["symbol"]).filter(
        (F.col("hi") >= F.col("from")) & (F.col("lo") <= F.col("to"))).select("symbol", "q", "k", "from", "values")


def thresholds_from_blocks(blocks: DataFrame, probs: tuple[float, float] = VOL_PROBS) -> DataFrame:
    """A9 from stored blocks: (symbol, vol_lo, vol_hi), equal to ``vol_thresholds`` over all days."""
    narrow = blocks.select("symbol", "n", "lo", "hi")
    brackets = materialize(rank_brackets(narrow, probs), "rank_brackets")
    below = join_null_safe(narrow, brackets, ["symbol"]).filter(F.col("hi") < F.col("from")).groupBy("symbol", "q").agg(
        F.sum("n").alias("base"))
    # values below the bracket are one row, equal values inside it are one row
    value = F.explode("values")
    near = overlapping_blocks(blocks, brackets).select("symbol", "q", "k", "from", value.alias("v"))
    steps = near.groupBy("symbol", "q", F.when(F.col("v") >= F.col("from"), F.col("v")).alias("v")).agg(
        F.count(F.lit(1)).alias("c"), F.max("k").alias("k"))
    order = Window.partitionBy("symbol", "q").orderBy(F.col("v").asc_nulls_first())
    upto = F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.coalesce("base", F.lit(0))
    found = join_null_safe(steps, below, ["symbol", "q"], "left").withColumn("upto", upto).filter(
        F.col("v").isNotNull() & (F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("c") < F.col("k")))
    lo, hi = probs
    return found.groupBy("symbol").agg(
        F.max(F.when(F.col("q") == lo, F.col("v"))).alias("vol_lo"), F.max(F.when(F.col("q") == hi, F.col("v"))).alias("vol_hi"))
