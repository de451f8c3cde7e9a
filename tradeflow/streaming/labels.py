"""Regime labels for streamed bars.

Each micro-batch of finalised bars (the output of ``streaming.bars``) is
labelled in ``foreachBatch``:

* window rows: per symbol in the batch, the stored bars from the
  ``lookback``-th bar before the batch's first minute through its last minute
  (a top-k per symbol finds the start), read from the bar store;
* features over those rows with the ordinary window operators, so every
  batch bar sees exactly the rows its frames need;
* labels against a stored threshold table, read again for every batch (the
  batch job refreshes it, since terciles are defined over the whole history).

Each batch's own bars are written to ``batch=<id>`` (overwritten if the
batch is retried), so the output equals the batch labels computed with the
same thresholds, exactly once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeflow.operators.bars import rolling_features
from tradeflow.operators.regimes import label_bars
from tradeflow.plans.lineage import shared_checkpoint_dir
from tradeflow.schema import BAR_LAYER_SCHEMA

BAR_COLUMNS = ["symbol", "ts_min", "mid_min"]


def _window_rows(keys: DataFrame, store: DataFrame, lookback: int) -> tuple[DataFrame, DataFrame]:
    """Stored bars from the ``lookback``-th bar before each symbol's first batch
    minute through its last, and per symbol how many earlier bars were found."""
    span = keys.groupBy("symbol").agg(F.min("ts_min").alias("_start"), F.max("ts_min").alias("_end"))
    stored = store.select(*BAR_COLUMNS).join(span, "symbol")
    w = Window.partitionBy("symbol").orderBy(F.col("ts_min").desc())
    reach = (
        stored.filter(F.col("ts_min") < F.col("_start"))
        .withColumn("_k", F.row_number().over(w))
        .filter(F.col("_k") <= lookback)
        .groupBy("symbol").agg(F.min("ts_min").alias("_from"), F.count(F.lit(1)).alias("_n_before"))
    )
    rows = (
        stored.join(reach, "symbol", "left")
        .filter((F.col("ts_min") >= F.coalesce("_from", "_start")) & (F.col("ts_min") <= F.col("_end")))
        .select(*BAR_COLUMNS)
    )
    found = span.join(reach, "symbol", "left").select("symbol", F.coalesce("_n_before", F.lit(0)).alias("_n"))
    return rows, found


def label_batch(batch: DataFrame, store: DataFrame, thresholds: DataFrame, lookback: int = 60,
                fast: int = 20, slow: int = 60, history_days: int | None = None) -> DataFrame:
    """Labelled rows of ``batch`` given the bar store (which holds every bar up to
    the batch's last minute) and the stored ``thresholds``.

    Per symbol the window rows are the stored bars from the ``lookback``-th bar
    before the batch's first minute through its last minute: exactly what the
    frames of the batch's bars read, even when a batch's minutes interleave
    with another batch's.  With ``history_days`` the store is first pruned to
    the days from (first batch day - history_days) on (partition pruning on
    ``trade_date``); symbols with fewer than ``lookback`` earlier bars in that
    range are looked up again in the whole store, so the result stays exact.
    """
    keys = batch.select("symbol", "ts_min")
    if history_days is None:
        rows, _ = _window_rows(keys, store, lookback)
    else:
        first = batch.agg(F.min("ts_min")).first()[0]
        if first is None:
            rows, _ = _window_rows(keys, store, lookback)
        else:
            floor = F.date_sub(F.lit(first).cast("date"), int(history_days))
            recent_rows, found = _window_rows(keys, store.filter(F.col("trade_date") >= floor), lookback)
            short = found.filter(F.col("_n") < lookback).select("symbol")
            if short.isEmpty():
                rows = recent_rows
            else:
                full_rows, _ = _window_rows(keys.join(short, "symbol", "left_semi"), store, lookback)
                rows = recent_rows.join(short, "symbol", "left_anti").unionByName(full_rows)
    marked = rows.join(keys.withColumn("_own", F.lit(True)), ["symbol", "ts_min"], "left") \
        .fillna(False, subset=["_own"])
    feats = rolling_features(marked, ["symbol"], "ts_min", fast, slow)
    return label_bars(feats.filter("_own").drop("_own"), thresholds)


def start_label_stream(spark: SparkSession, bars_source: str,
                       thresholds: DataFrame | Callable[[SparkSession], DataFrame], sink: str,
                       checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                       lookback: int = 60, history_days: int | None = 2) -> StreamingQuery:
    """Stream bars stored under ``bars_source`` -> labelled bars appended under ``sink``.

    ``thresholds`` is a table, or a function that reads the batch job's latest
    one; the function is asked again for every batch.
    """
    stream = spark.readStream.schema(BAR_LAYER_SCHEMA)
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    bars = stream.parquet(bars_source)
    if checkpoint is None:
        root = shared_checkpoint_dir(spark)
        key = hashlib.sha1(f"{bars_source}|{sink}".encode()).hexdigest()[:16]
        checkpoint = f"{root.rstrip('/')}/tradeflow-streams/labels-{key}"

    def process(batch: DataFrame, batch_id: int) -> None:
        store = batch.sparkSession.read.schema(BAR_LAYER_SCHEMA).parquet(bars_source)
        current = thresholds(batch.sparkSession) if callable(thresholds) else thresholds
        out = label_batch(batch, store, current, lookback, history_days=history_days)
        # one folder per batch, overwritten on a retry: idempotent output
        out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    return (
        bars.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
