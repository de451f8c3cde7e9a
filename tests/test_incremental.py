"""Layers that merge by day: thresholds, gold and distinct accounts, and the job by delta."""

from __future__ import annotations

import glob
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tests.test_io_job import HEADER
from tradeflow.model import TradeModel
from tradeflow.operators import account_performance, rollup_day_tier_trend, rollup_regime_symbol, vol_thresholds
from tradeflow.operators.bitmaps import account_bitmaps, distinct_accounts, number_accounts
from tradeflow.operators.daily import daily_rollups, gold_a_from_daily, gold_c_from_daily, performance_from_daily
from tradeflow.operators.vol_blocks import overlapping_blocks, rank_brackets, thresholds_from_blocks, vol_blocks
from tradeflow.plans import explain_text
from tradeflow.plans.incremental import IncrementLayout, build_increments, days_within, read_bitmaps, refresh
from tradeflow.plans.job import Layout, run_job
from tradeflow.plans.lineage import materialize
from tradeflow.schema import BAR_LAYER_SCHEMA, BRONZE_SCHEMA, FEATURE_SCHEMA, SILVER_SCHEMA, TRADE_COLUMNS
from tradeflow.sources import read_layer


def features(spark, days=40, seed=1):
    rnd = random.Random(seed)
    rows = []
    for symbol in ("a", "b", None, "flat", "one", "none"):
        for day in range(1 if symbol == "one" else days):
            for _ in range(1 if symbol == "one" else rnd.randint(0, 90)):
                value = {"flat": 0.5, "none": None}.get(symbol, round(rnd.random(), 2) if symbol == "b" else rnd.random())
                rows.append((symbol, f"2024-{1 + day // 28:02d}-{1 + day % 28:02d}", value))
    return spark.createDataFrame(rows, "symbol string, day string, vol_20 double").select(
        "symbol", F.col("day").cast("date").alias("trade_date"), "vol_20")


@pytest.mark.parametrize("block_values", [1, 7, 32])
def test_thresholds_from_blocks(spark, block_values):
    stored = materialize(features(spark), "features")
    blocks = materialize(vol_blocks(stored, block_values=block_values), "blocks")
    got = {r["symbol"]: (r["vol_lo"], r["vol_hi"]) for r in thresholds_from_blocks(blocks).collect()}
    want = {}
    values: dict = {}
    for r in stored.filter("vol_20 IS NOT NULL").collect():
        values.setdefault(r["symbol"], []).append(r["vol_20"])
    for symbol, own in values.items():
        own.sort()
        want[symbol] = tuple(own[max(1, math.ceil(q * len(own))) - 1] for q in (0.33, 0.66))
    assert got == want and None in got
    assert got == {r["symbol"]: (r["vol_lo"], r["vol_hi"]) for r in vol_thresholds(stored).collect()}
    assert thresholds_from_blocks(blocks.limit(0)).count() == 0


def test_values_are_read_inside_the_bracket_only(spark):
    blocks = materialize(vol_blocks(features(spark).filter("symbol = 'a'"), block_values=4), "blocks")
    near = overlapping_blocks(blocks, materialize(rank_brackets(blocks), "brackets"))
    plan = explain_text(near)
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters") and "hi" in line and "lo" in line]
    assert pushed and "values" in plan
    held = near.select(F.sum(F.size("values"))).first()[0]
    assert held < 0.4 * blocks.agg(F.sum("n")).first()[0]


def rounded(df, places=6):
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)])


def same(a, b, places=6):
    a, b = rounded(a, places), rounded(b, places).select(*sorted(a.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gold_from_daily_rollups(spark):
    silver = TradeModel(spark, SF0001).silver
    # rows without a PnL, an account, a symbol or a day; a label of its own for the gaps
    gap = F.pmod(F.xxhash64("trade_id"), F.lit(11))
    silver = materialize(silver.withColumns({
        "net_pnl": F.when(gap == 0, None).otherwise(F.col("net_pnl")), "account_id": F.when(gap == 1, None).otherwise(F.col("account_id")),
        "symbol": F.when(gap == 2, None).otherwise(F.col("symbol")), "trade_date": F.when(gap == 3, None).otherwise(F.col("trade_date")),
        "vol_regime": F.when(gap == 4, "unknown").when(gap == 5, None).otherwise(F.col("vol_regime"))}), "silver")
    daily = materialize(daily_rollups(silver), "daily")
    assert same(gold_a_from_daily(daily), rollup_regime_symbol(silver))
    assert same(performance_from_daily(daily), account_performance(silver))
    assert same(gold_c_from_daily(daily), rollup_day_tier_trend(silver))


def test_distinct_accounts_of_any_range(spark):
    silver = TradeModel(spark, SF0001).silver.select("trade_date", "tier", "vol_regime", "account_id")
    silver = materialize(silver.unionByName(spark.range(70_000).select(  # accounts of three bitmaps
        F.lit("2024-01-07").cast("date").alias("trade_date"), F.lit("prop").alias("tier"), F.lit(None).cast("string").alias("vol_regime"),
        F.when(F.col("id") > 0, F.concat(F.lit("N"), "id")).alias("account_id"))), "silver")
    first = materialize(number_accounts(silver.filter("trade_date < '2024-01-10'"), bucket_accounts=1000), "numbers")
    numbers = materialize(number_accounts(silver, known=first, bucket_accounts=10), "numbers")
    held = [r["number"] for r in numbers.collect()]
    assert sorted(held) == list(range(silver.select("account_id").filter("account_id IS NOT NULL").distinct().count()))
    assert first.exceptAll(numbers).count() == 0
    bitmaps = materialize(account_bitmaps(silver, numbers), "bitmaps")
    for start, end, keys in ((None, None, ["tier", "vol_regime"]), ("2024-01-05", "2024-01-09", ["tier"]), ("2024-01-12", "2024-01-12", ["vol_regime"])):
        rows = silver
        if start:
            rows = rows.filter(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        want = rows.filter("account_id IS NOT NULL").groupBy(*keys).agg(F.count_distinct("account_id").alias("n_accounts"))
        assert same(distinct_accounts(bitmaps, keys, start, end), want)


def test_days_within_the_lookback(spark):
    day = lambda i: F.lit(f"2024-01-{i:02d}").cast("date")
    bars = None
    for i, n in ((1, 50), (2, 30), (3, 30), (5, 40), (9, 10)):
        part = spark.range(n).select(F.lit("a").alias("symbol"), day(i).alias("trade_date"))
        bars = part if bars is None else bars.unionByName(part)
    bars = bars.unionByName(spark.range(5).select(F.lit("thin").alias("symbol"), day(20).alias("trade_date")))
    found = [d.day for d in days_within(bars, [spark.range(1).select(day(1)).first()[0]])]
    assert found == [2, 3, 20]  # 30 bars stand between day 1 and day 3, 60 before day 5; thin has none before day 20
    back = [d.day for d in days_within(bars, [spark.range(1).select(day(9)).first()[0]], after=False)]
    assert back == [3, 5]


def csv(folder, name, rows):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *[",".join(str(x) for x in r) for r in rows]]) + "\n")
    return path


def fields(row, **changes):
    out = {c: row[c] for c in TRADE_COLUMNS} | changes
    out["ts"] = out["ts"].strftime("%Y-%m-%d %H:%M:%S")
    return [out[c] for c in TRADE_COLUMNS]


def layers(spark, layout):
    yield "bars", read_layer(spark, layout.bars, BAR_LAYER_SCHEMA)
    yield "features", read_layer(spark, layout.features, FEATURE_SCHEMA)
    yield "silver", read_layer(spark, layout.silver, SILVER_SCHEMA)
    for name in ("gold_regime", "gold_ranking", "gold_daily"):
        yield name, spark.read.parquet(getattr(layout, name))


def test_refresh_equals_a_full_rebuild(spark, scratch_dir):
    full, delta = Layout(os.path.join(scratch_dir, "a")), Layout(os.path.join(scratch_dir, "b"))
    for layout in (full, delta):
        run_job(spark, layout.root, events_dir=SF0001)
    build_increments(spark, delta)
    trades = {r["trade_id"]: r for r in read_layer(spark, full.bronze, BRONZE_SCHEMA).collect()}
    days = sorted({r["trade_date"] for r in trades.values()})
    one = [r for r in trades.values() if r["trade_date"] == days[12]]

    # 1: a corrected PnL moves no price: its day only
    silver_files = {f: os.path.getmtime(f) for f in glob.glob(f"{delta.silver}/*/*/*.parquet")}
    late = csv(scratch_dir, "late1.csv", [fields(one[0], realized_pnl=4321.5)])
    run_job(spark, full.root, late_csv=late)
    report = refresh(spark, delta.root, late)
    assert report.counts["touched_days"] == 1 and report.counts["moved_thresholds"] == 0
    for (name, a), (_, b) in zip(layers(spark, full), layers(spark, delta), strict=True):
        assert same(a, b), name
    changed = {f"trade_date={d}" for d in days if f"trade_date={d}" in " ".join(
        set(glob.glob(f"{delta.silver}/*/*/*.parquet")) - set(silver_files))}
    assert len(changed) == report.counts["silver_days"] < len(days) and f"trade_date={days[12]}" in changed

    # 2: a price and a time change, a new account, a day that empties
    gone = [r for r in trades.values() if r["trade_date"] == days[0]]
    moved = [fields(r, ts=one[1]["ts"], trade_date=days[12]) for r in gone]
    spread = 1 + (one[2]["fill_price"] / one[2]["mid_price"] - 1)
    price = one[2]["mid_price"] * 1.5
    notional = round(price * spread * one[2]["quantity"], 4)
    new = fields(one[2], trade_id="T777", account_id="ACC9999", mid_price=price, fill_price=price * spread, notional=price * spread * one[2]["quantity"],
                 fee_amount=notional * one[2]["fee_bps"] / 1e4)
    late = csv(scratch_dir, "late2.csv", [*moved, new])
    run_job(spark, full.root, late_csv=late)
    report = refresh(spark, delta.root, late)
    assert report.counts["late"] == len(moved) + 1 and report.counts["moved_thresholds"] > 0
    for (name, a), (_, b) in zip(layers(spark, full), layers(spark, delta), strict=True):
        assert same(a, b), name
    silver = read_layer(spark, delta.silver, SILVER_SCHEMA)
    assert same(distinct_accounts(read_bitmaps(spark, delta)),
                silver.groupBy("tier", "vol_regime").agg(F.count_distinct("account_id").alias("n_accounts")))


def test_refresh_reads_the_touched_days_silver_only(spark, scratch_dir):
    layout = Layout(os.path.join(scratch_dir, "wh"))
    run_job(spark, layout.root, events_dir=SF0001)
    build_increments(spark, layout)
    trades = read_layer(spark, layout.bronze, BRONZE_SCHEMA).orderBy("trade_date", "trade_id").collect()
    last = trades[-1]
    want = {r["vol_regime"]: r["n"] for r in spark.read.parquet(layout.gold_regime).groupBy("vol_regime").agg(F.sum("n_trades").alias("n")).collect()}
    # silver of every other day cannot be read any more
    for f in glob.glob(f"{layout.silver}/*/*/*.parquet"):
        if f"trade_date={last['trade_date']}" not in f:
            with open(f, "wb") as out:
                out.write(b"no parquet")
            check = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(check):
                os.unlink(check)
    report = refresh(spark, layout.root, csv(scratch_dir, "late.csv", [fields(last, realized_pnl=1000000.25)]))
    assert report.counts["silver_days"] == 1
    gold = spark.read.parquet(layout.gold_regime)
    assert {r["vol_regime"]: r["n"] for r in gold.groupBy("vol_regime").agg(F.sum("n_trades").alias("n")).collect()} == want
    assert spark.read.parquet(layout.gold_ranking).agg(F.max("total_pnl")).first()[0] > 900_000
    assert os.path.exists(IncrementLayout(layout).daily)
