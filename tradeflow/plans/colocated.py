"""Trades and minute bars stored side by side: silver without moving the trades.

The trades are dealt to buckets by cell (``operators.cells``) when bronze is
written - the one exchange that the layer's write needs anyway - and the
labelled bars, which are small, are dealt to the same number of buckets.  The
join of the two then reads bucket by bucket: no exchange above the trades.  A
cell is a part of one (trade_date, symbol), so the tasks of the join write
silver's partitions directly, with one file for each cell.

A hot symbol is many cells; the split table is a function of the minute
counts, so a day that changes is dealt anew on its own and all other days
keep their files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeflow.operators.cells import CELL, CELL_ROWS, bars_with_cell, split_table, trades_with_cell
from tradeflow.operators.regimes import attach_labels
from tradeflow.sinks.buckets import colocating, open_buckets, replace_partitions, write_buckets

#: trades that one bucket, that is one task of the join, takes about
BUCKET_ROWS = 2_000_000


class ColocatedLayers:
    """Bucketed trades and bars under ``root`` (the trades under ``trades_path`` if given).

    Keys of the join: the cell, then symbol and minute as everywhere else.
    """

    keys: Sequence[str] = (CELL, "symbol", "ts_min")

    def __init__(self, spark: SparkSession, root: str, trades_path: str | None = None,
                 cell_rows: int = CELL_ROWS, bucket_rows: int = BUCKET_ROWS):
        self.spark = colocating(spark)
        root = root.rstrip("/")
        self.paths = {"trades": trades_path or f"{root}/trades", "bars": f"{root}/labelled_bars"}
        self.splits_path, self.spec_path = f"{root}/cell_splits", f"{root}/cell_spec"
        self.cell_rows, self.bucket_rows = cell_rows, bucket_rows
        self.names = {k: f"tradeflow_{k}_{hashlib.md5(p.encode()).hexdigest()}" for k, p in self.paths.items()}

    def plan(self, counted: DataFrame, keep_buckets: bool = False) -> None:
        """Store the split table of ``counted`` bars, and with a first load the number of buckets."""
        split_table(counted, self.cell_rows).write.mode("overwrite").parquet(self.splits_path)
        if not keep_buckets:
            total = counted.agg(F.sum("n_trades")).first()[0] or 0
            most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
            buckets = min(most, max(self.spark.sparkContext.defaultParallelism, -(-total // self.bucket_rows)))
            self.spark.createDataFrame([(buckets,)], "buckets int").write.mode("overwrite").parquet(self.spec_path)

    @property
    def buckets(self) -> int:
        return self.spark.read.parquet(self.spec_path).first()["buckets"]

    @property
    def splits(self) -> DataFrame:
        return self.spark.read.schema("symbol string, day date, slots int, copies map<timestamp, int>").parquet(self.splits_path)

    def write_trades(self, trades: DataFrame) -> None:
        write_buckets(trades_with_cell(trades, self.splits), self.paths["trades"], self.names["trades"], self.buckets,
                      CELL, ["trade_date"], ["ts"])

    def write_bars(self, bars: DataFrame) -> None:
        write_buckets(bars_with_cell(bars, self.splits), self.paths["bars"], self.names["bars"], self.buckets, CELL, [], ["ts_min"])

    def replace_days(self, trades: DataFrame, counted: DataFrame) -> None:
        """Replace the days of ``trades``, all of whose rows it holds; ``counted`` are those days' bars."""
        self.open_trades(trades.schema)
        replace_partitions(trades_with_cell(trades, split_table(counted, self.cell_rows)), self.names["trades"], self.buckets, CELL)

    def open_trades(self, schema: StructType) -> DataFrame:
        """The stored trades, registered anew (days come and go)."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != CELL)
        return open_buckets(self.spark, self.paths["trades"], self.names["trades"], self.buckets, CELL,
                            f"{columns}, {CELL} bigint", ["trade_date"], ["ts"])

    @property
    def trades(self) -> DataFrame:
        return self.spark.table(self.names["trades"])

    @property
    def bars(self) -> DataFrame:
        return self.spark.table(self.names["bars"])

    def silver(self) -> DataFrame:
        """The trades with their bar's labels, from the two stored layers."""
        return attach_labels(self.trades, self.bars, on=self.keys).drop(CELL)
