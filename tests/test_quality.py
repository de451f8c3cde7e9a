"""Expectation checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.operators.quality import expectation_split
from tradeflow.sources.fixtures import trades_from_events
from tests.conftest import SF0001


def test_clean_trades_pass_every_rule(spark):
    trades = trades_from_events(spark.read.parquet(f"{SF0001}/events.parquet"))
    passed, failed, obs = expectation_split(trades)
    assert passed.count() == 1000
    assert failed.count() == 0
    counts = obs.get
    assert counts["n_rows"] == 1000 and all(counts[k] == 0 for k in counts if k != "n_rows")
    assert counts["n_failed"] == 0


def test_broken_rows_are_quarantined_with_their_rules(spark):
    trades = trades_from_events(spark.read.parquet(f"{SF0001}/events.parquet"))
    broken = (
        trades.withColumn("side", F.when(F.col("trade_id") == "T1000003", "HOLD").otherwise(F.col("side")))
        .withColumn("quantity", F.when(F.col("trade_id") == "T1000005", -1.0).otherwise(F.col("quantity")))
        .withColumn("fee_amount", F.when(F.col("trade_id") == "T1000007", F.lit(None)).otherwise(F.col("fee_amount")))
    )
    passed, failed, obs = expectation_split(broken)
    assert passed.count() == 997
    rows = {r.trade_id: sorted(r.failed_rules) for r in failed.collect()}
    assert rows["T1000003"] == ["known_side"]
    assert "positive_quantity" in rows["T1000005"]
    assert rows["T1000007"] == ["fee_matches_schedule"]
    assert obs.get["known_side"] == 1 and obs.get["n_rows"] == 1000 and obs.get["n_failed"] == 3
