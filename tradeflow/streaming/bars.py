"""Minute bars from a stream of trades.

The batch bar operator as an event-time windowed aggregate: a watermark
bounds the state (one open window per symbol and minute within the delay),
and append mode emits each bar once, when the watermark has passed its end,
so late trades inside the delay are still counted and the output files never
change.  Bars finalised by the stream equal the batch ``minute_bars``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeflow.plans.lineage import shared_checkpoint_dir
from tradeflow.schema import BRONZE_SCHEMA


def stream_minute_bars(trades: DataFrame, delay: str = "2 minutes", price: str = "mid_price") -> DataFrame:
    """Streaming (symbol, ts_min, mid_min, n_trades) bars with a watermark on ``ts``."""
    return (
        trades.withWatermark("ts", delay)
        .groupBy("symbol", F.window("ts", "1 minute"))
        .agg(F.avg(price).alias("mid_min"), F.count(F.lit(1)).alias("n_trades"))
        .select(
            "symbol",
            F.col("window.start").alias("ts_min"),
            "mid_min",
            "n_trades",
            F.to_date(F.col("window.start")).alias("trade_date"),
        )
    )


def start_bar_stream(spark: SparkSession, source: str, sink: str, checkpoint: str | None = None,
                     delay: str = "2 minutes", available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Trades landing as Parquet under ``source`` -> bars appended under ``sink``.

    The query's checkpoint lives in the shared ``spark.checkpoint.dir`` unless
    a location is given, so a restarted driver resumes where it stopped.
    """
    trades = spark.readStream.schema(BRONZE_SCHEMA).parquet(source)
    if checkpoint is None:
        root = shared_checkpoint_dir(trades.sparkSession)
        # stable across driver restarts (Python's hash() is salted per process)
        key = hashlib.sha1(f"{source}|{sink}".encode()).hexdigest()[:16]
        checkpoint = f"{root.rstrip('/')}/tradeflow-streams/bars-{key}"
    writer = (
        stream_minute_bars(trades, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .partitionBy("trade_date")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
