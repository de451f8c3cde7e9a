"""Ingest of new files only (S1, S5, S6): the landing folder as a file stream.

The stream's checkpoint is the log of ingested files: a run takes the files
that no committed batch has taken and ends (``availableNow``).  A batch that
dies is given again, with the same files, by the next run; every write of a
batch gives the same result when it is repeated:

* bronze takes the good rows by upsert on ``trade_id`` (the first batch of an
  empty warehouse is a plain load of one row for each id);
* rows that did not parse, or failed an expectation, replace the batch's own
  partition of the stream's quarantine;
* the batch's counts replace its own partition of the ingest report.

With ``by_delta`` the layers below bronze follow in the same batch, rebuilt
where the batch touched them (``plans.incremental``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.plans.incremental import IncrementLayout, build_increments, refresh_days
from tradeflow.plans.job import (
    JobReport,
    Layout,
    build_bars,
    build_features,
    build_gold,
    build_silver,
    clear_staging,
    route_trades,
    upsert_bronze,
)
from tradeflow.schema import BRONZE_SCHEMA, TRADE_SCHEMA
from tradeflow.sinks import write_layer
from tradeflow.sources import read_layer
from tradeflow.sources.files import flag_bad, trades_csv_reader


class StreamLayout:
    """What the stream keeps beside the job's layers."""

    def __init__(self, layout: Layout):
        at = f"{layout.root.rstrip('/')}/warehouse/ingest"
        self.log, self.report, self.quarantine = f"{at}/log", f"{at}/report", f"{at}/quarantine"


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _one_for_each_id(trades: DataFrame) -> DataFrame:
    """The row that an upsert of ``trades`` would keep for each id."""
    columns = BRONZE_SCHEMA.fieldNames()
    order = Window.partitionBy("trade_id").orderBy(F.col("ts").desc(), F.struct(*[c for c in columns if c != "ts"]).desc())
    return trades.withColumn("_row", F.row_number().over(order)).filter("_row = 1").select(*columns)


def ingest_batch(batch: DataFrame, number: int, layout: Layout, by_delta: bool = False) -> dict[str, int]:
    """One batch of raw lines into the warehouse; repeating it changes nothing."""
    spark, own = batch.sparkSession, StreamLayout(layout)
    staged = route_trades(flag_bad(batch, TRADE_SCHEMA), layout)
    counts = {route: staged["n"].get(route, 0) for route in ("good", "failed", "bad")}
    for route in ("failed", "bad"):
        write_layer(staged[route].withColumn("batch", F.lit(number)), f"{own.quarantine}/{route}", ["batch"], dynamic=True)
    complete = path_exists(spark, f"{layout.bronze}/_SUCCESS")
    if complete:
        touched = upsert_bronze(spark, layout, staged["good"])
    else:
        write_layer(_one_for_each_id(staged["good"]), layout.bronze, ["trade_date"], sort_by=["ts"])
        touched = [r["trade_date"] for r in read_layer(spark, layout.bronze, BRONZE_SCHEMA).select("trade_date").distinct().collect()]
    if by_delta:
        if path_exists(spark, f"{IncrementLayout(layout).bitmaps}/_SUCCESS"):  # the last layer that is built
            refresh_days(spark, layout, touched)
        else:
            for build in (build_bars, build_features, build_silver, build_gold, build_increments):
                build(spark, layout)
    report = spark.createDataFrame([(r, n, number) for r, n in counts.items()], "route string, n_rows long, batch long")
    write_layer(report, own.report, ["batch"], dynamic=True)
    clear_staging(spark, layout)
    return counts


def ingest_new_files(spark: SparkSession, root: str, folder: str, by_delta: bool = False, max_files: int | None = None,
                     batch: Callable[..., dict[str, int]] = ingest_batch) -> JobReport:
    """Ingest the files of ``folder`` that no earlier run has ingested; the counts of this run.

    ``max_files`` bounds the files of one batch: a large backlog becomes several batches.
    """
    layout, report = Layout(root), JobReport(counts={"good": 0, "failed": 0, "bad": 0, "batches": 0})

    def each(df: DataFrame, number: int) -> None:
        for route, n in batch(df, number, layout, by_delta).items():
            report.counts[route] += n
        report.counts["batches"] += 1

    reader = trades_csv_reader(spark.readStream, TRADE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (reader.csv(folder).writeStream.foreachBatch(each)
             .option("checkpointLocation", StreamLayout(layout).log).trigger(availableNow=True).start())
    query.awaitTermination()
    return report


def ingest_report(spark: SparkSession, root: str) -> DataFrame:
    """(batch, route, n_rows) of every committed batch."""
    return spark.read.schema("route string, n_rows long, batch long").parquet(StreamLayout(Layout(root)).report)
