"""Trades and bars in shared buckets: same silver, no exchange above the trades, hot symbols and minutes split."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tests.conftest import SF0001
from tests.test_io_job import GOOD, GOOD2, HEADER
from tradeflow.model import TradeModel
from tradeflow.operators import attach_labels, label_bars, minute_bars, vol_thresholds
from tradeflow.operators.bars import bar_features
from tradeflow.operators.cells import CELL, bars_with_cell, counted_bars, split_table, trades_with_cell
from tradeflow.plans import explain_text
from tradeflow.plans.colocated import ColocatedLayers
from tradeflow.plans.job import Layout, colocated_layers, run_job
from tradeflow.plans.lineage import materialize
from tradeflow.schema import BRONZE_SCHEMA, SILVER_SCHEMA
from tradeflow.sources import read_layer


def hot_trades(spark):
    """Half of all trades in one symbol, a fifth of all in one of its minutes; null symbols and times."""
    trades = TradeModel(spark, SF0001).trades
    n = F.hash("trade_id")
    hot = trades.withColumn("symbol", F.when(F.pmod(n, F.lit(2)) == 0, "HOT").otherwise(F.col("symbol")))
    hot = hot.withColumn("ts", F.when(F.pmod(n, F.lit(5)) == 0, F.lit("2024-01-05 10:30:00").cast("timestamp")).otherwise(F.col("ts")))
    hot = hot.withColumn("symbol", F.when(F.pmod(n, F.lit(97)) == 0, F.lit(None)).otherwise(F.col("symbol")))
    hot = hot.withColumn("ts", F.when(F.pmod(n, F.lit(89)) == 0, F.lit(None)).otherwise(F.col("ts")))
    return materialize(hot.withColumn("trade_date", F.coalesce(F.to_date("ts"), F.lit("2024-01-05").cast("date"))), "hot_trades")


def labelled(trades):
    features = materialize(bar_features(minute_bars(trades)), "hot_features")
    return label_bars(features, vol_thresholds(features))


def test_cells_are_bounded(spark):
    trades = hot_trades(spark)
    splits = split_table(counted_bars(trades), cell_rows=20)
    cells = trades_with_cell(trades, splits)
    assert cells.count() == trades.count()
    assert cells.groupBy(CELL).count().agg(F.max("count")).first()[0] <= 60
    assert cells.filter("symbol = 'HOT'").select(CELL).distinct().count() > 20
    # one (symbol, day) a cell, and a trade's bar is in the trade's cell, once
    assert cells.groupBy(CELL).agg(F.count_distinct(F.coalesce("symbol", F.lit("")), F.coalesce(F.to_date("ts"), F.lit("2000-01-01").cast("date"))).alias("n")).filter("n > 1").count() == 0
    bars = bars_with_cell(counted_bars(trades), splits)
    assert bars.groupBy(CELL, "symbol", "ts_min").count().filter("count > 1").count() == 0
    met = cells.withColumn("ts_min", F.date_trunc("minute", "ts")).filter("symbol IS NOT NULL AND ts IS NOT NULL")
    assert met.join(bars, [CELL, "symbol", "ts_min"], "left_anti").count() == 0


def test_silver_without_moving_trades(spark, scratch_dir):
    trades = hot_trades(spark)
    store = ColocatedLayers(spark, scratch_dir, cell_rows=20, bucket_rows=100)
    store.plan(materialize(counted_bars(trades), "counted"))
    store.write_trades(trades)
    bars = materialize(labelled(trades), "labelled")
    store.write_bars(bars)
    got = store.silver()
    want = attach_labels(trades, bars).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # neither side of the join is exchanged when it is no broadcast
    store.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = explain_text(store.silver())
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    # the hot symbol's trades are read by many tasks
    tasks = store.trades.filter("symbol = 'HOT'").select(F.input_file_name().alias("f"), "symbol")
    held = [r["count"] for r in tasks.groupBy(F.regexp_extract("f", r"_(\d+)\.c000", 1).alias("bucket")).count().collect()]
    assert len(held) == store.buckets == 10 and max(held) < 0.35 * sum(held)


def test_no_trades(spark, scratch_dir):
    trades = TradeModel(spark, SF0001).trades.limit(0)
    store = ColocatedLayers(spark, scratch_dir)
    store.plan(counted_bars(trades))
    store.write_trades(trades)
    store.write_bars(labelled(trades))
    assert store.silver().count() == 0


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_job_with_colocated_layers(spark, scratch_dir):
    plain, shared = Layout(os.path.join(scratch_dir, "a")), Layout(os.path.join(scratch_dir, "b"))
    run_job(spark, plain.root, events_dir=SF0001)
    run_job(spark, shared.root, events_dir=SF0001, colocated=True, cell_rows=30, bucket_rows=200)
    for path, schema in (("bronze", BRONZE_SCHEMA), ("silver", SILVER_SCHEMA)):
        a, b = (rounded(read_layer(spark, getattr(x, path), schema)) for x in (plain, shared))
        assert a.count() == b.count() == 1000 and a.exceptAll(b).count() == 0, path
    a, b = (rounded(spark.read.parquet(x.gold_ranking)) for x in (plain, shared))
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    # a session that does not know the tables reads them again
    again = colocated_layers(spark, shared)
    spark.sql(f"DROP TABLE {again.names['trades']}")
    assert again.open_trades(BRONZE_SCHEMA).count() == 1000


def test_late_trades_replace_their_days_only(spark, scratch_dir):
    def csv(name, *rows):
        path = os.path.join(scratch_dir, name)
        with open(path, "w") as f:
            f.write("\n".join([HEADER, *rows]) + "\n")
        return path

    third = GOOD2.replace("2024-01-02", "2024-01-04").replace("T1000001", "T1000009")
    root = os.path.join(scratch_dir, "wh")
    report = run_job(spark, root, csv=csv("raw.csv", GOOD, GOOD2, third), colocated=True)
    assert report.counts["ingested"] == 3
    layout = Layout(root)
    kept = os.path.join(layout.bronze, "trade_date=2024-01-01")
    files = sorted(os.listdir(kept))
    # one trade moves to a day of its own, another day gets a second trade
    moved = GOOD2.replace("2024-01-02", "2024-01-03")
    new = third.replace("T1000009", "T1000010")
    run_job(spark, root, late_csv=csv("late.csv", moved, new), colocated=True)
    silver = read_layer(spark, layout.silver, SILVER_SCHEMA)
    assert {(r.trade_id, str(r.trade_date)) for r in silver.collect()} == {
        ("T1000000", "2024-01-01"), ("T1000001", "2024-01-03"), ("T1000009", "2024-01-04"), ("T1000010", "2024-01-04")}
    assert sorted(os.listdir(kept)) == files
    assert all(r.vol_regime is not None for r in silver.collect())
