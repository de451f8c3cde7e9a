"""Pruning on a second key (F2, F3, O5): files ordered by a space-filling curve over time and account.

Files sorted by time let a reader skip row groups by time only: every row group
holds all accounts.  Along a Z-order curve neighbouring rows are close in time
*and* in account, so the row groups' statistics are narrow in both, and a filter
on either key, or on both, skips most of them.

The curve's coordinates keep the order of the keys: the second of the day, and
the account's place among ranges of the sorted accounts (found once, from the
distinct accounts).  Their bits are interleaved by built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.functions import epoch_seconds
from tradeflow.plans.lineage import join_null_safe, materialize

#: bits of each coordinate
CURVE_BITS = 10
DAY_SECONDS = 86_400


def interleave(coordinates: Sequence[Column], bits: int = CURVE_BITS) -> Column:
    """The place of a point on the Z-order curve: the bits of its coordinates in turn, the highest first."""
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for i, c in enumerate(reversed(list(coordinates))):
            one = F.shiftright(c.cast("long"), bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(coordinates) + i))
    return place


def account_places(trades: DataFrame, account: str = "account_id", bits: int = CURVE_BITS) -> DataFrame:
    """(account, _place): the range, of at most ``2 ** bits``, that each account falls into; order is kept."""
    accounts = trades.select(account).filter(F.col(account).isNotNull()).distinct()
    return materialize(accounts.repartitionByRange(1 << bits, account).select(
        account, F.spark_partition_id().cast("long").alias("_place")), "account_places")


def write_curve_layer(trades: DataFrame, path: str, places: DataFrame | None = None, ts: str = "ts", account: str = "account_id",
                      keys: Sequence[str] = ("trade_date",), bits: int = CURVE_BITS, mode: str = "overwrite", **options: str) -> None:
    """Write ``trades`` partitioned by ``keys``, rows inside the files along the curve over (time of day, account).

    NULL accounts and times stand first on their axis.  ``options`` go to the writer.
    """
    places = account_places(trades, account, bits) if places is None else places
    second = F.pmod(epoch_seconds(ts), F.lit(DAY_SECONDS))
    time = F.coalesce(F.floor(second * F.lit(1 << bits) / F.lit(DAY_SECONDS)), F.lit(0))
    placed = join_null_safe(trades, places, [account], "left").withColumn(
        "_curve", interleave([time, F.coalesce("_place", F.lit(0))], bits)).drop("_place")
    ordered = placed.hint("rebalance", *keys).sortWithinPartitions(*keys, "_curve", ts).drop("_curve")
    ordered.write.mode(mode).options(**options).partitionBy(*keys).parquet(path)
