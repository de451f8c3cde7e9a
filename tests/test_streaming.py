"""Streaming bars (N3) equal the batch bars for every finalised minute."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from tradeflow.operators import minute_bars
from tradeflow.sources.fixtures import trades_from_events
from tradeflow.streaming import start_bar_stream
from tests.conftest import SF0001


def test_stream_bars_equal_batch_bars(spark, scratch_dir):
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    trades = trades_from_events(events)
    source = os.path.join(scratch_dir, "landing")
    # two landing batches, the second one holding the later half of the day range
    cut = F.lit("2024-01-15").cast("date")
    trades.filter(F.col("trade_date") < cut).write.parquet(source + "/part=1")
    trades.filter(F.col("trade_date") >= cut).write.parquet(source + "/part=2")
    sink = os.path.join(scratch_dir, "bars")
    q = start_bar_stream(spark, source + "/*", sink, checkpoint=os.path.join(scratch_dir, "ckpt"),
                         delay="2 minutes")
    q.awaitTermination(240)
    streamed = spark.read.parquet(sink)
    batch = minute_bars(trades)
    max_ts = trades.agg(F.max("ts")).first()[0]
    n_stream = streamed.count()
    assert n_stream > 0
    # every streamed bar equals its batch bar
    joined = streamed.alias("s").join(batch.alias("b"), ["symbol", "ts_min"], "left")
    assert joined.filter(F.col("b.mid_min").isNull()).count() == 0
    assert joined.filter(F.abs(F.col("s.mid_min") - F.col("b.mid_min")) > 1e-9).count() == 0
    # only bars the watermark has not passed yet may be missing
    missing = batch.join(streamed, ["symbol", "ts_min"], "left_anti")
    late = missing.filter(F.col("ts_min") < F.lit(max_ts) - F.expr("INTERVAL 3 MINUTES")).count()
    assert late == 0
    assert n_stream + missing.count() == batch.count()


def test_default_stream_checkpoint_resumes_in_the_shared_folder(spark, scratch_dir):
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    source = os.path.join(scratch_dir, "landing")
    trades_from_events(events).filter(F.col("trade_date") < F.lit("2024-01-10").cast("date")) \
        .write.parquet(source + "/part=1")
    sink = os.path.join(scratch_dir, "bars")
    start_bar_stream(spark, source + "/*", sink).awaitTermination(240)
    first = spark.read.parquet(sink).count()
    # a second start with the same source and sink resumes: nothing is reprocessed
    start_bar_stream(spark, source + "/*", sink).awaitTermination(240)
    assert spark.read.parquet(sink).count() == first > 0


@pytest.mark.parametrize("history_days", [None, 0, 2])
def test_streamed_labels_equal_batch_labels(spark, scratch_dir, history_days):
    from tradeflow.operators import bar_features, label_bars, vol_thresholds
    from tradeflow.schema import BAR_LAYER_SCHEMA
    from tradeflow.streaming import start_label_stream

    events = spark.read.parquet(f"{SF0001}/events.parquet")
    trades = trades_from_events(events)
    source = os.path.join(scratch_dir, "landing")
    cut = F.lit("2024-01-15").cast("date")
    trades.filter(F.col("trade_date") < cut).write.parquet(source + "/part=1")
    trades.filter(F.col("trade_date") >= cut).write.parquet(source + "/part=2")
    bars_dir = os.path.join(scratch_dir, "bars")
    start_bar_stream(spark, source + "/*", bars_dir, checkpoint=os.path.join(scratch_dir, "c1")).awaitTermination(240)

    stored = spark.read.schema(BAR_LAYER_SCHEMA).parquet(bars_dir).drop("trade_date")
    feats = bar_features(stored)
    thresholds = vol_thresholds(feats)
    expected = label_bars(feats, thresholds).select("symbol", "ts_min", "vol_20", "vol_regime", "trend_regime")

    out = os.path.join(scratch_dir, "labels")
    n_files = sum(f.endswith(".parquet") for _, _, fs in os.walk(bars_dir) for f in fs)
    q = start_label_stream(spark, bars_dir, thresholds, out, checkpoint=os.path.join(scratch_dir, "c2"),
                           max_files_per_trigger=max(1, n_files // 3),  # about three micro-batches
                           history_days=history_days)
    q.awaitTermination(600)
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() > 1  # several micro-batches
    got = got.select("symbol", "ts_min", "vol_20", "vol_regime", "trend_regime")
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@pytest.mark.parametrize("history_days", [None, 1])
def test_label_batch_with_pruned_history_is_exact(spark, history_days):
    from tradeflow.operators import bar_features, label_bars, minute_bars, vol_thresholds
    from tradeflow.sources.fixtures import trades_raw_from_events
    from tradeflow.streaming import label_batch
    from tests.conftest import SF001

    bars = minute_bars(trades_raw_from_events(spark.read.parquet(f"{SF001}/events.parquet")))
    store = bars.withColumn("trade_date", F.to_date("ts_min"))
    feats = bar_features(bars)
    thresholds = vol_thresholds(feats)
    expected = label_bars(feats, thresholds).filter(F.to_date("ts_min") == F.lit("2024-01-20").cast("date"))
    batch = store.filter(F.col("trade_date") == F.lit("2024-01-20").cast("date"))
    got = label_batch(batch, store, thresholds, history_days=history_days)
    cols = ["symbol", "ts_min", "vol_20", "sma_60", "vol_regime", "trend_regime"]
    assert got.count() == expected.count() > 0
    assert got.select(*cols).exceptAll(expected.select(*cols)).count() == 0
