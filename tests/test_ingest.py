"""The landing folder as a file stream: every file once, batches that can be repeated."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.test_incremental import same
from tests.test_io_job import BAD_PX, BAD_TS, GOOD, GOOD2, HEADER
from tradeflow.plans.job import Layout, run_job
from tradeflow.schema import BRONZE_SCHEMA, SILVER_SCHEMA
from tradeflow.sources import read_layer
from tradeflow.streaming.ingest import StreamLayout, ingest_batch, ingest_new_files, ingest_report

WRONG = GOOD.replace("T1000000", "T7").replace("BUY", "WRONG")


def land(folder, name, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join([HEADER, *rows]) + "\n")


def bronze_ids(spark, root):
    return sorted(r.trade_id for r in read_layer(spark, Layout(root).bronze, BRONZE_SCHEMA).collect())


def test_every_file_is_ingested_once(spark, scratch_dir):
    folder, root = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "wh")
    land(folder, "a.csv", GOOD, BAD_TS)
    land(folder, "b.csv", GOOD2, WRONG, BAD_PX)
    assert ingest_new_files(spark, root, folder).counts == {"good": 2, "failed": 1, "bad": 2, "batches": 1}
    assert ingest_new_files(spark, root, folder).counts == {"good": 0, "failed": 0, "bad": 0, "batches": 0}
    land(folder, "c.csv", GOOD.replace("T1000000", "T5"), BAD_TS)
    assert ingest_new_files(spark, root, folder).counts == {"good": 1, "failed": 0, "bad": 1, "batches": 1}
    assert bronze_ids(spark, root) == ["T1000000", "T1000001", "T5"]
    own = StreamLayout(Layout(root))
    assert spark.read.parquet(f"{own.quarantine}/bad").count() == 3
    assert [r.trade_id for r in spark.read.parquet(f"{own.quarantine}/failed").collect()] == ["T7"]
    assert {(r.batch, r.route): r.n_rows for r in ingest_report(spark, root).collect()} == {
        (0, "good"): 2, (0, "failed"): 1, (0, "bad"): 2, (1, "good"): 1, (1, "failed"): 0, (1, "bad"): 1}


def test_a_backlog_in_several_batches(spark, scratch_dir):
    folder, root = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "wh")
    for i in range(3):
        land(folder, f"{i}.csv", GOOD.replace("T1000000", f"T{i}"))
    land(folder, "again.csv", GOOD.replace("T1000000", "T1"))  # a delivery repeated under another name
    counts = ingest_new_files(spark, root, folder, max_files=1).counts
    assert counts["batches"] == 4 and counts["good"] == 4
    assert bronze_ids(spark, root) == ["T0", "T1", "T2"]


def test_a_killed_batch_leaves_no_duplicates(spark, scratch_dir):
    folder, root = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "wh")
    land(folder, "a.csv", GOOD, BAD_TS)
    ingest_new_files(spark, root, folder)
    land(folder, "b.csv", GOOD2, WRONG, BAD_PX)

    def dying(*args):
        ingest_batch(*args)
        raise RuntimeError("killed after its writes, before the commit")

    with pytest.raises(StreamingQueryException):
        ingest_new_files(spark, root, folder, batch=dying)
    land(folder, "c.csv", GOOD.replace("T1000000", "T5"))
    assert ingest_new_files(spark, root, folder).counts == {"good": 2, "failed": 1, "bad": 1, "batches": 2}
    assert bronze_ids(spark, root) == ["T1000000", "T1000001", "T5"]
    own = StreamLayout(Layout(root))
    assert spark.read.parquet(f"{own.quarantine}/bad").count() == 2 and spark.read.parquet(f"{own.quarantine}/failed").count() == 1


def test_layers_follow_by_delta(spark, scratch_dir):
    folder, root = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "wh")
    rows = [GOOD.replace("T1000000", f"T{i}").replace("00:00:07", f"00:{i:02d}:07") for i in range(30)]
    late = GOOD2.replace("2024-01-02", "2024-01-01")
    land(folder, "a.csv", *rows[:20])
    ingest_new_files(spark, root, folder, by_delta=True)
    land(folder, "b.csv", *rows[20:], late, GOOD2.replace("T1000001", "T99"))
    ingest_new_files(spark, root, folder, by_delta=True)
    whole = os.path.join(scratch_dir, "whole")
    run_job(spark, whole, csv=folder)
    a, b = (read_layer(spark, Layout(x).silver, SILVER_SCHEMA) for x in (root, whole))
    assert a.count() == 32 and same(a, b)
    for name in ("gold_regime", "gold_ranking", "gold_daily"):
        x, y = (spark.read.parquet(getattr(Layout(r), name)) for r in (root, whole))
        assert same(x, y), name
    assert a.filter(F.col("trade_id") == "T99").count() == 1
