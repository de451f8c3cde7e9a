"""Bars, rolling features and the forward markout on hand-made and driver data."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradeflow.operators import bar_features, forward_mid, label_bars, minute_bars, vol_thresholds
from tradeflow.sources.fixtures import trades_raw_from_events
from tests.conftest import SF001

T0 = datetime(2024, 1, 1)


def bars_df(spark, mids, minutes=None, symbol="S"):
    minutes = minutes if minutes is not None else list(range(len(mids)))
    rows = [(symbol, T0 + timedelta(minutes=m), float(p) if p is not None else None)
            for m, p in zip(minutes, mids)]
    return spark.createDataFrame(rows, "symbol string, ts_min timestamp, mid_min double")


def collect_sorted(df, *cols):
    return [r.asDict() for r in df.orderBy(*cols).collect()]


@pytest.mark.parametrize("chunk", [None, 59, 100_000])
def test_warm_up_series(spark, chunk):
    rows = collect_sorted(bar_features(bars_df(spark, [1, 2, 3, 4, 5]), chunk_rows=chunk), "ts_min")
    vols = [None if r["vol_20"] is None else round(r["vol_20"], 6) for r in rows]
    assert vols == [None, 0.0, 0.143841, 0.170306, 0.180164]
    assert rows[0]["log_return"] is None
    assert rows[1]["log_return"] == pytest.approx(0.6931471805599453)
    assert rows[4]["sma_20"] == pytest.approx(3.0)
    thr = vol_thresholds(bar_features(bars_df(spark, [1, 2, 3, 4, 5])))
    labels = collect_sorted(label_bars(bar_features(bars_df(spark, [1, 2, 3, 4, 5])), thr), "ts_min")
    assert [r["trend_regime"] for r in labels] == ["chop"] * 5
    assert labels[0]["vol_regime"] == "unknown"


def test_single_bar_is_unknown(spark):
    feats = bar_features(bars_df(spark, [7.0]))
    (row,) = label_bars(feats, vol_thresholds(feats)).collect()
    assert row["vol_regime"] == "unknown" and row["vol_20"] is None


def test_gap_is_crossed_by_lag(spark):
    rows = collect_sorted(bar_features(bars_df(spark, [10, 11, 12], minutes=[0, 1, 50])), "ts_min")
    assert rows[2]["prev_mid"] == 11.0


def test_zero_price_gives_null_return_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = collect_sorted(bar_features(bars_df(spark, [0.0, 5.0, 0.0])), "ts_min")
    assert [r["log_return"] for r in rows] == [None, None, None]


def test_chunked_features_equal_plain_on_driver_data(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    bars = minute_bars(trades_raw_from_events(events))
    cols = ["prev_mid", "log_return", "sma_20", "sma_60", "vol_20"]
    plain = bar_features(bars, chunk_rows=None)
    chunked = bar_features(bars, chunk_rows=97)  # many blocks per symbol
    diff = (
        plain.alias("p").join(chunked.alias("c"), ["symbol", "ts_min"], "full_outer")
        .filter(" OR ".join(f"NOT (p.{c} <=> c.{c})" for c in cols) + " OR p.mid_min IS NULL OR c.mid_min IS NULL")
    )
    assert bars.count() == chunked.count()
    assert diff.count() == 0


def test_chunked_markout_equals_plain(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    bars = minute_bars(trades_raw_from_events(events))
    plain = forward_mid(bars, chunk_seconds=None)
    chunked = forward_mid(bars, chunk_seconds=3600)
    diff = plain.alias("p").join(chunked.alias("c"), ["symbol", "ts_min"], "full_outer").filter(
        "NOT (p.fwd_mid <=> c.fwd_mid)")
    assert chunked.count() == bars.count()
    assert diff.count() == 0


def test_markout_at_series_end_uses_last_bar(spark):
    bars = bars_df(spark, [10, 11, 12, 13], minutes=[0, 20, 45, 90])
    rows = collect_sorted(forward_mid(bars), "ts_min")
    # frame [t, t+30min]: 0 -> 20's mid, 20 -> 45's mid, 45 -> itself, 90 -> itself (end)
    assert [r["fwd_mid"] for r in rows] == [11.0, 12.0, 12.0, 13.0]


def test_markout_chunk_boundary(spark):
    # bars around midnight: the frame of 23:50 reaches 00:10 of the next chunk
    minutes = [24 * 60 - 10, 24 * 60 + 10, 24 * 60 + 45]
    rows = collect_sorted(forward_mid(bars_df(spark, [1, 2, 3], minutes=minutes)), "ts_min")
    assert [r["fwd_mid"] for r in rows] == [2.0, 2.0, 3.0]


def test_thresholds_split_bars_into_terciles(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    feats = bar_features(minute_bars(trades_raw_from_events(events)))
    labelled = label_bars(feats, vol_thresholds(feats)).filter(F.col("vol_20").isNotNull())
    counts = labelled.groupBy("symbol").pivot("vol_regime", ["low", "medium", "high"]).count().collect()
    for r in counts:
        n = r["low"] + r["medium"] + r["high"]
        assert abs(r["low"] - 0.33 * n) <= 2
        assert abs(r["low"] + r["medium"] - 0.66 * n) <= 2


def test_approx_thresholds_equal_exact_discrete_percentiles(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    feats = bar_features(minute_bars(trades_raw_from_events(events)))
    approx = {r.symbol: (r.vol_lo, r.vol_hi) for r in vol_thresholds(feats).collect()}
    exact = {
        r.symbol: (r.lo, r.hi)
        for r in feats.filter(F.col("vol_20").isNotNull()).groupBy("symbol").agg(
            F.expr("percentile_disc(0.33) WITHIN GROUP (ORDER BY vol_20)").alias("lo"),
            F.expr("percentile_disc(0.66) WITHIN GROUP (ORDER BY vol_20)").alias("hi"),
        ).collect()
    }
    assert approx == exact


def test_bar_ordinals_are_contiguous_per_symbol_with_a_hot_symbol(spark):
    from pyspark.sql import Window

    from tradeflow.operators import bar_ordinals

    # one hot symbol with bars on every minute of 3 days, two sparse ones
    hot = spark.range(0, 3 * 1440).select(
        F.lit("HOT").alias("symbol"),
        (F.lit(T0).cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts_min"),
        F.lit(1.0).alias("mid_min"))
    cold = spark.range(0, 3 * 1440, 97).select(
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("symbol"),
        (F.lit(T0).cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts_min"),
        F.lit(2.0).alias("mid_min"))
    bars = hot.unionByName(cold)
    numbered = bar_ordinals(bars)
    w = Window.partitionBy("symbol").orderBy("ts_min")
    wrong = numbered.withColumn("_expect", F.row_number().over(w) - 1).filter(F.col("_idx") != F.col("_expect"))
    assert numbered.count() == bars.count()
    assert wrong.count() == 0


def test_negative_and_null_prices_give_null_returns_not_errors(spark):
    rows = collect_sorted(bar_features(bars_df(spark, [5.0, -1.0, None, 4.0, 8.0])), "ts_min")
    assert [r["log_return"] for r in rows][:4] == [None, None, None, None]
    assert rows[4]["log_return"] == pytest.approx(0.6931471805599453)
    # averages skip the NULL mid; the first non-NULL return gives vol 0.0
    assert rows[2]["sma_20"] == pytest.approx(2.0)
    assert rows[4]["vol_20"] == 0.0
