"""A kept leaderboard (W5-W7, O6): stored ranges of the ranking, of which a change rewrites its own.

The ranking's rows are stored by (vol_regime, symbol, range): a range holds
neighbouring positions of one group, in the order of the ranking (value, then
account).  A table of ranges, one row each, keeps the first position, number of
rows, number of distinct values, sum, first and last value.  Ranks are local
ranks plus running totals over a group's ranges, so

* a change of some accounts finds the ranges of their old and new positions,
  rewrites these, cuts those that have grown too long, and leaves all other
  files as they are;
* the best ``n`` accounts of a group are in its first ranges: no other is read.

NULL groups, accounts and values are kept in the order that ``rank_accounts``
gives them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.operators.ranking import RANGE_ROWS, RANK_KEYS, leading_accounts, range_stats, ranks_over_ranges
from tradeflow.plans.lineage import join_null_safe, materialize, shared_checkpoint_dir
from tradeflow.sinks import write_layer
from tradeflow.sinks.files import partition_folder, remove_partitions

KEYS = list(RANK_KEYS)
VALUE, ACCOUNT = "total_pnl", "account_id"
ROW_SCHEMA = ("account_id string, tier string, n_trades long, total_pnl double, gross_notional double, total_fees double, "
              "vol_regime string, symbol string, _range long")
COLUMNS = ["account_id", "tier", "vol_regime", "symbol", "n_trades", "total_pnl", "gross_notional", "total_fees"]


def position() -> Column:
    """Where a row stands in its group, as a value that sorts ascending."""
    return F.struct(F.col(VALUE).isNull().alias("none"), (-F.col(VALUE)).alias("down"), F.col(ACCOUNT).alias("account"))


class RankIndex:
    def __init__(self, spark: SparkSession, path: str, range_rows: int = RANGE_ROWS):
        self.spark, self.range_rows = spark, range_rows
        self.rows_path, self.ranges_path = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/ranges"
        self.staging = f"{shared_checkpoint_dir(spark).rstrip('/')}/tradeflow"

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(ROW_SCHEMA).parquet(self.rows_path)

    @property
    def ranges(self) -> DataFrame:
        return self.spark.read.parquet(self.ranges_path)

    def build(self, perf: DataFrame) -> None:
        """Store the ranking of ``perf`` (the result of ``account_performance``)."""
        stored = materialize(perf.select(*COLUMNS), "rank_rows", self.staging)
        cut = materialize(self._cut(stored, 0), "rank_cut", self.staging)
        self._write(cut)
        self._stats(cut).write.mode("overwrite").parquet(self.ranges_path)

    def _cut(self, rows: DataFrame, first: int) -> DataFrame:
        """``rows`` with new ranges of about ``range_rows``, numbered from ``first``."""
        n = max(1, -(-rows.count() // self.range_rows))
        order = [F.col(VALUE).desc_nulls_last(), F.col(ACCOUNT).asc_nulls_first()]
        return rows.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in KEYS], *order).withColumn(
            "_range", (F.lit(first) + F.spark_partition_id()).cast("long"))

    def _write(self, rows: DataFrame) -> None:
        write_layer(rows, self.rows_path, [*KEYS, "_range"], sort_by=[VALUE], dynamic=True)

    def _stats(self, rows: DataFrame) -> DataFrame:
        lows = rows.groupBy(*KEYS, "_range").agg(F.min(position()).alias("low"))
        return join_null_safe(range_stats(rows, KEYS, VALUE), lows, [*KEYS, "_range"])

    def locate(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the range that their position falls into (the group's first before it; null in a new group)."""
        # a line for each range: a list far smaller than the accounts
        bounds = self.ranges.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("low", "_range"))).alias("bounds"))
        at = rows.withColumn("at", position())
        below = F.filter("bounds", lambda b: b["low"] <= F.col("at"))
        found = F.coalesce(F.try_element_at(below, F.lit(-1)), F.try_element_at("bounds", F.lit(1)))
        return join_null_safe(at, bounds, KEYS, "left").withColumn("_range", F.when(F.size("bounds") > 0, found)["_range"]).drop("at", "bounds")

    def change(self, gone: DataFrame, new: DataFrame) -> int:
        """Take the rows of ``gone`` out and put those of ``new`` in; the number of ranges rewritten.

        Both have the columns of ``account_performance``; an account whose
        numbers change is in both, as it was and as it is.
        """
        gone = materialize(self.locate(gone.select(*COLUMNS)), "rank_gone", self.staging)
        new = materialize(self.locate(new.select(*COLUMNS)), "rank_new", self.staging)
        touched = gone.select(*KEYS, "_range").unionByName(new.select(*KEYS, "_range")).distinct().filter("_range IS NOT NULL")
        touched = [tuple(r) for r in touched.collect()]  # names of ranges
        next_range = (self.ranges.agg(F.max("_range")).first()[0] or 0) + 1
        mine = F.lit(False)
        for regime, symbol, number in touched:
            mine = mine | (F.col(KEYS[0]).eqNullSafe(regime) & F.col(KEYS[1]).eqNullSafe(symbol) & (F.col("_range") == number))
        stay = join_null_safe(self.rows.filter(mine), gone.select(*KEYS, ACCOUNT, "tier"), [*KEYS, ACCOUNT, "tier"], "left_anti")
        after = materialize(stay.select(*COLUMNS, "_range").unionByName(new.select(*COLUMNS, "_range")), "rank_after", self.staging)
        counts = after.groupBy(*KEYS, "_range").agg(F.count(F.lit(1)).alias("rows"))
        long = counts.filter((F.col("rows") > 2 * self.range_rows) | F.col("_range").isNull()).select(*KEYS, "_range")
        long = materialize(long, "rank_long", self.staging)
        grown = materialize(join_null_safe(after, long, [*KEYS, "_range"], "left_semi").select(*COLUMNS), "rank_grown", self.staging)
        cut = join_null_safe(after, long, [*KEYS, "_range"], "left_anti").select(*COLUMNS, "_range").unionByName(self._cut(grown, next_range))
        cut = materialize(cut, "rank_cut", self.staging)
        stats = self._stats(cut).unionByName(self.ranges.filter(~mine))
        materialize(stats, "rank_stats", self.staging).write.mode("overwrite").parquet(self.ranges_path)
        self._write(cut)
        held = {tuple(r) for r in cut.select(*KEYS, "_range").distinct().collect()}
        remove_partitions(self.spark, self.rows_path, [
            partition_folder(self.spark, **dict(zip([*KEYS, "_range"], t, strict=True))) for t in touched if t not in held])
        return len(touched)

    def ranking(self) -> DataFrame:
        """The whole ranking, as ``rank_accounts`` gives it."""
        return ranks_over_ranges(self.rows, self.ranges, COLUMNS, KEYS, VALUE, ACCOUNT, order_by="low")

    def first_ranges(self, regime: str, symbol: str, n: int) -> list[int]:
        """The ranges that hold the group's best ``n`` rows."""
        ahead = Window.partitionBy(*KEYS).orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
        own = self.ranges.filter((F.col(KEYS[0]) == regime) & (F.col(KEYS[1]) == symbol))
        own = own.withColumn("ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        return [r["_range"] for r in own.filter(F.col("ahead") < n).select("_range").collect()]

    def top(self, regime: str, symbol: str, n: int = 10) -> DataFrame:
        """The best ``n`` accounts of a group, from its first ranges alone (a partition filter)."""
        first = self.rows.filter(F.col("_range").isin(self.first_ranges(regime, symbol, n)))
        return leading_accounts(first, regime, symbol, n).drop("_range")


def changed_rows(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``before`` that are not in ``after``, and the other way round."""
    columns = [F.col(c) for c in COLUMNS]
    return before.select(*columns).exceptAll(after.select(*columns)), after.select(*columns).exceptAll(before.select(*columns))
