"""Exact distributed discrete quantiles equal percentile_disc."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tradeflow.operators import bar_features, minute_bars, vol_thresholds
from tradeflow.operators.quantiles import exact_quantiles
from tradeflow.sources.fixtures import trades_raw_from_events
from tests.conftest import SF001


def _disc(df, group, value, probs):
    return {
        (r[group], p): r[f"p{i}"]
        for r in df.filter(F.col(value).isNotNull()).groupBy(group).agg(*[
            F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})").alias(f"p{i}")
            for i, p in enumerate(probs)]).collect()
        for i, p in enumerate(probs)
    }


def test_exact_quantiles_with_ties_nulls_and_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 300))) for _ in range(20000)]
    rows += [("cold", float(rnd.randint(0, 5))) for _ in range(37)]
    rows += [("one", 7.0), ("nul", None), ("nul", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0001, 0.33, 0.5, 0.66, 0.9999, 1.0]
    got = {(r.g, r.q): r.value_q for r in exact_quantiles(df, "g", "v", probs, accuracy=100).collect()}
    assert got == _disc(df, "g", "v", probs)


def test_exact_thresholds_equal_percentile_disc_on_driver_bars(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    feats = bar_features(minute_bars(trades_raw_from_events(events)))
    exact = {r.symbol: (r.vol_lo, r.vol_hi) for r in vol_thresholds(feats).collect()}
    disc = _disc(feats, "symbol", "vol_20", [0.33, 0.66])
    assert exact == {s: (disc[(s, 0.33)], disc[(s, 0.66)]) for s, _ in disc}
