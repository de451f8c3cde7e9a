"""Distinct accounts that merge (A7): account numbers and bitmaps per day.

Every account gets a number once, and numbers never change.  A day's accounts
of a group are bitmaps of numbers (32,768 numbers a bitmap), and bitmaps merge
by OR, so the exact number of distinct accounts of any range of days is a count
of bits: no account and no trade is read.  NULL accounts are counted by nobody,
as COUNT(DISTINCT) does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.plans.lineage import materialize

BITMAP_KEYS = ("tier", "vol_regime")
#: accounts that one bucket, that is one task, numbers about
BUCKET_ACCOUNTS = 200_000


def number_accounts(trades: DataFrame, known: DataFrame | None = None, bucket_accounts: int = BUCKET_ACCOUNTS) -> DataFrame:
    """(account_id, number) of the accounts in ``trades`` and ``known``; known numbers stay, new ones follow them.

    New accounts are numbered inside hashed buckets, after the accounts of the
    buckets before: no task sees all accounts.
    """
    fresh = trades.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known, "account_id", "left_anti")
    fresh = materialize(fresh, "new_accounts")
    next_number = 0 if known is None else (known.agg(F.max("number")).first()[0] or -1) + 1
    buckets = max(1, -(-fresh.count() // bucket_accounts))
    dealt = fresh.withColumn("_bucket", F.pmod(F.xxhash64("account_id"), F.lit(buckets)))
    # one row for each bucket
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("account_id"))
    numbered = dealt.withColumn("_row", inside).join(ahead, "_bucket").select(
        "account_id", (F.lit(next_number) + F.col("_ahead") + F.col("_row") - 1).cast("long").alias("number"))
    return numbered if known is None else known.select("account_id", "number").unionByName(numbered)


def account_bitmaps(silver: DataFrame, numbers: DataFrame, keys: Sequence[str] = BITMAP_KEYS) -> DataFrame:
    """(trade_date, keys, bucket, accounts): the accounts of each day and group as bitmaps.

    Trades reduce to distinct accounts before they meet their numbers.
    """
    seen = silver.select("trade_date", *keys, "account_id").distinct()
    # bit positions of the functions start at 1
    number = F.col("number") + 1
    return seen.join(numbers, "account_id").groupBy("trade_date", *keys, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("accounts"))


def distinct_accounts(bitmaps: DataFrame, keys: Sequence[str] = BITMAP_KEYS, start: str | None = None, end: str | None = None) -> DataFrame:
    """(keys, n_accounts): distinct accounts of each group between two days (inclusive), from stored bitmaps.

    ``keys`` may be fewer than the stored ones.
    """
    day = F.col("trade_date")
    for bound, keep in ((start, lambda x: day >= x), (end, lambda x: day <= x)):
        if bound is not None:
            bitmaps = bitmaps.filter(keep(F.lit(bound).cast("date")))
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("accounts").alias("accounts"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("accounts")).alias("n_accounts"))
