"""Files along a curve over time and account: fewer row groups for one account, same rows."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tradeflow.sinks import write_layer
from tradeflow.sinks.curve import interleave, write_curve_layer


def row_groups(path, may_hold):
    """(row groups whose statistics admit the filter, all row groups) of the day's files."""
    hits = total = 0
    for f in glob.glob(f"{path}/trade_date=2024-01-05/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            total += 1
            hits += may_hold({n: meta.row_group(g).column(i).statistics for n, i in names.items()})
    return hits, total


def test_interleave(spark):
    points = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x long, y long")
    got = {(r.x, r.y): r.z for r in points.select("x", "y", interleave([F.col("x"), F.col("y")], 3).alias("z")).collect()}
    want = {(x, y): int("".join(a + b for a, b in zip(f"{x:03b}", f"{y:03b}")), 2) for x, y in got}
    assert got == want


def test_fewer_row_groups_for_one_account(spark, scratch_dir):
    n = 60_000
    trades = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("T"), "id").alias("trade_id"),
        F.when(F.col("id") % 1000 == 7, None).otherwise(F.timestamp_seconds(F.lit(1704412800) + F.pmod(F.hash("id"), F.lit(86400)))).alias("ts"),
        F.when(F.col("id") % 500 == 3, None).otherwise(F.format_string("ACC%04d", F.pmod(F.xxhash64("id"), F.lit(800)))).alias("account_id"),
        (F.col("id") * 1.5).alias("notional"), F.lit("2024-01-05").cast("date").alias("trade_date"))
    small = {"parquet.block.size": "4096", "parquet.page.size": "1024", "parquet.block.size.row.check.min": "100",
             "parquet.page.size.row.check.min": "100", "parquet.page.size.row.check.max": "100"}
    by_time, by_curve = os.path.join(scratch_dir, "time"), os.path.join(scratch_dir, "curve")
    # one writing task a day, so that the order is all that differs
    ordered = trades.coalesce(1).sortWithinPartitions("ts")
    ordered.write.options(**small).partitionBy("trade_date").parquet(by_time)
    write_curve_layer(trades, by_curve, **small)
    one, low, high = "ACC0123", F.lit("2024-01-05 09:00:00").cast("timestamp"), F.lit("2024-01-05 10:00:00").cast("timestamp")
    for keep in (F.col("account_id") == one, F.col("ts").between(low, high), (F.col("account_id") == one) & F.col("ts").between(low, high),
                 F.col("account_id").isNull(), F.lit(True)):
        a, b = (spark.read.parquet(p).filter(keep) for p in (by_time, by_curve))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0

    def holds_one(stats):
        s = stats["account_id"]
        return s is not None and s.has_min_max and s.min <= one <= s.max

    time_hits, time_all = row_groups(by_time, holds_one)
    curve_hits, curve_all = row_groups(by_curve, holds_one)
    assert time_all > 20 and curve_all > 20
    assert time_hits > 0.9 * time_all and curve_hits < 0.4 * curve_all


def test_empty_and_dates(spark, scratch_dir):
    trades = spark.createDataFrame([], "ts timestamp, account_id string, trade_date date")
    write_curve_layer(trades, os.path.join(scratch_dir, "none"))
    write_layer(trades, os.path.join(scratch_dir, "plain"), ["trade_date"])
    assert spark.read.schema(trades.schema).parquet(os.path.join(scratch_dir, "none")).count() == 0
