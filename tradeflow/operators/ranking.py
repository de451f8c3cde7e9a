"""Rankings and top-k.

Ties (D10): ``dense_rank`` orders by PnL only, so equal PnL shares a rank;
``row_number`` and the running sum add ``account_id`` as a tie-breaker so
they are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.plans.lineage import join_null_safe, materialize

RANK_KEYS = ("vol_regime", "symbol")
# Rows of the ranking that one range (one task) takes.
RANGE_ROWS = 200_000


def rank_accounts(perf: DataFrame, keys: Sequence[str] = RANK_KEYS, value: str = "total_pnl",
                  tiebreak: str = "account_id", range_rows: int | None = RANGE_ROWS) -> DataFrame:
    """W5-W7 / gold B: dense rank, row number and running PnL, best first.

    The same plan at every size: the rows are range-partitioned on (group,
    value, tie-breaker) into ranges of about ``range_rows`` rows - a hot group
    or a value that many accounts share spans several - ranked inside their
    range, and completed by running totals over the ranges of their group.
    ``range_rows=None`` is the textbook window over each group that it must
    equal.
    """
    keys = list(keys)
    if range_rows is None:
        w_rank = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
        w_row = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last(), F.col(tiebreak).asc_nulls_first())
        # The finer ordering (value, then tie-breaker) is computed first: its sort
        # also satisfies the dense rank's ordering, so one sort serves all three.
        with_rows = perf.select(
            "*",
            F.row_number().over(w_row).cast("long").alias("pnl_row_num"),
            F.sum(value).over(w_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cumulative_pnl"),
        )
        return with_rows.withColumn("pnl_rank", F.dense_rank().over(w_rank).cast("long")).select(
            *perf.columns, "pnl_rank", "pnl_row_num", "cumulative_pnl")

    stored = materialize(perf, "ranking_input")
    ranges = max(1, -(-stored.count() // range_rows))
    order = [F.col(value).desc_nulls_last(), F.col(tiebreak).asc_nulls_first()]
    # the range of each row is stored with it: every reader sees the same ranges
    marked = materialize(
        stored.repartitionByRange(ranges, *[F.col(k).asc_nulls_first() for k in keys], *order)
        .withColumn("_range", F.spark_partition_id()), "ranking_ranges")

    return ranks_over_ranges(marked, range_stats(marked, keys, value), perf.columns, keys, value, tiebreak)


def range_stats(marked: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row for each (group, ``_range``): rows, distinct values, sum, first and last value in rank order."""
    v = F.col(value)
    return marked.groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_n"),
        (F.count_distinct(v) + F.max(F.when(v.isNull(), 1).otherwise(0))).alias("_nd"),
        F.sum(value).alias("_s"),
        F.max(v).alias("_first"),
        F.when(F.count(v) == F.count(F.lit(1)), F.min(v)).alias("_last"),
    )


def ranks_over_ranges(marked: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str], value: str,
                      tiebreak: str, order_by: str = "_range") -> DataFrame:
    """W5-W7 of rows cut into ranges: ranked inside their range, completed by running totals over the group's ranges.

    ``order_by`` is the column of ``stats`` in whose order a group's ranges follow.
    """
    part = [*keys, "_range"]
    order = [F.col(value).desc_nulls_last(), F.col(tiebreak).asc_nulls_first()]
    w_row = Window.partitionBy(*part).orderBy(*order)
    w_dense = Window.partitionBy(*part).orderBy(order[0])
    local = marked.select(
        "*",
        F.row_number().over(w_row).alias("_rn"),
        F.sum(value).over(w_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_cum"),
    ).withColumn("_dr", F.dense_rank().over(w_dense))
    # a value that continues from the range before counts once
    w_ranges = Window.partitionBy(*keys).orderBy(order_by)
    continues = F.when(F.lag("_n").over(w_ranges).isNotNull() & F.lag("_last").over(w_ranges).eqNullSafe(F.col("_first")), 1)
    before = w_ranges.rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_joined", F.coalesce(continues, F.lit(0)))
    offsets = stats.select(
        *part,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"),
        (F.coalesce(F.sum(F.col("_nd") - F.col("_joined")).over(before), F.lit(0)) - F.col("_joined")).alias("_off_nd"),
        F.sum("_s").over(before).alias("_off_s"),
    )
    off_s, cum = F.col("_off_s"), F.col("_cum")
    running = F.when(off_s.isNull(), cum).when(cum.isNull(), off_s).otherwise(off_s + cum)
    return join_null_safe(local, offsets, part).select(
        *columns,
        (F.col("_off_nd") + F.col("_dr")).cast("long").alias("pnl_rank"),
        (F.col("_off_n") + F.col("_rn")).cast("long").alias("pnl_row_num"),
        running.alias("cumulative_pnl"),
    )


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    method: str = "dense_rank", rank_col: str = "pnl_rank") -> DataFrame:
    """Rows whose rank inside their group is <= n.

    Spark plans the rank filter as a WindowGroupLimit, which trims each group
    to its top rows before the shuffle as well as after it.
    """
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, fn().over(w).cast("long")).filter(F.col(rank_col) <= n)


def top_in_regime(ranking: DataFrame, regime: str = "high", max_rank: int = 5) -> DataFrame:
    """Q2 (F2, F3, F7): accounts ranked <= max_rank in one regime (partition-pruned)."""
    return (
        ranking.filter((F.col("vol_regime") == regime) & (F.col("pnl_rank") <= max_rank))
        .select("account_id", "tier", "symbol", "total_pnl", "pnl_rank")
        .orderBy("symbol", "pnl_rank", "account_id")
    )


def top_accounts(ranking: DataFrame, regime: str, symbol: str, n: int = 10) -> DataFrame:
    """The best ``n`` accounts for one (regime, symbol), ties broken by account."""
    return (
        ranking.filter((F.col("vol_regime") == regime) & (F.col("symbol") == symbol))
        .orderBy(F.col("pnl_rank").asc(), F.col("account_id").asc())
        .limit(n)
    )


def leading_accounts(perf: DataFrame, regime: str, symbol: str, n: int = 10, value: str = "total_pnl",
                     tiebreak: str = "account_id") -> DataFrame:
    """O6 without a full ranking: ``top_accounts`` of ``rank_accounts``, from the group's first ``n`` rows.

    The first rows of the order are cut per task before they meet (a
    WindowGroupLimit); ranks among them are those of the whole group, because
    all rows before them are there.
    """
    group = perf.filter((F.col("vol_regime") == regime) & (F.col("symbol") == symbol))
    best = F.col(value).desc_nulls_last()
    rows = Window.partitionBy(*RANK_KEYS).orderBy(best, F.col(tiebreak).asc_nulls_first())
    first = group.withColumn("pnl_row_num", F.row_number().over(rows).cast("long")).filter(F.col("pnl_row_num") <= n)
    return first.withColumn("pnl_rank", F.dense_rank().over(Window.partitionBy(*RANK_KEYS).orderBy(best)).cast("long"))
