"""File sources (S1-S5) with an explicit schema and a quality split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradeflow.schema import TRADE_SCHEMA

CORRUPT_COL = "_corrupt_record"

# Columns that must be present for a trade to be usable downstream.
REQUIRED_TRADE_COLUMNS = [f.name for f in TRADE_SCHEMA.fields]


@dataclass
class IngestReport:
    """Result of a typed CSV read: good rows, quarantined rows, and observed counts.

    The counts come from ``DataFrame.observe`` and are only filled in once an
    action (normally the bronze write) has run, so ingest needs no extra scan.
    ``good`` and ``bad`` both derive from ``parsed``: the job stores it once
    and splits the stored rows, so the input is parsed once.
    """

    parsed: DataFrame
    good: DataFrame
    bad: DataFrame
    good_metrics: Observation
    bad_metrics: Observation

    def counts(self) -> dict[str, int]:
        good = self.good_metrics.get.get("n_rows", 0)
        bad = self.bad_metrics.get.get("n_rows", 0)
        return {"good": int(good), "bad": int(bad)}


def corruptible(schema: StructType) -> StructType:
    """The CSV schema with a column for lines that do not parse."""
    return StructType([*schema.fields, StructField(CORRUPT_COL, StringType())])


def trades_csv_reader(reader, schema: StructType = TRADE_SCHEMA):
    """The options of S1 on a batch or stream reader: header, declared schema, bad lines kept."""
    return (reader.option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL).schema(corruptible(schema)))


def flag_bad(raw: DataFrame, schema: StructType = TRADE_SCHEMA) -> DataFrame:
    """``_bad``: rows whose text did not parse, or that miss a required field."""
    # a date is typed without failing: text that is no date becomes NULL, and the row is bad
    missing = F.col("trade_date").try_cast("date").isNull() if "trade_date" in schema.fieldNames() else F.lit(False)
    for name in REQUIRED_TRADE_COLUMNS:
        if name in schema.fieldNames():
            missing = missing | F.col(name).isNull()
    return raw.withColumn("_bad", F.col(CORRUPT_COL).isNotNull() | missing)


def read_trades_csv(spark: SparkSession, path: str, schema: StructType = TRADE_SCHEMA) -> IngestReport:
    """Headered CSV, explicit schema, no inference pass.

    Declared non-null flags are not enforced by the CSV reader, so rows whose
    text did not parse (or that miss a required field) are split off into
    ``bad`` with the raw line kept, instead of flowing on as NULLs.
    """
    parsed = flag_bad(trades_csv_reader(spark.read, schema).csv(path), schema)
    good_obs = Observation("ingest_good")
    bad_obs = Observation("ingest_bad")
    good = (parsed.filter(~F.col("_bad")).drop(CORRUPT_COL, "_bad")
            .observe(good_obs, F.count(F.lit(1)).alias("n_rows")))
    bad = parsed.filter(F.col("_bad")).drop("_bad").observe(bad_obs, F.count(F.lit(1)).alias("n_rows"))
    return IngestReport(parsed=parsed, good=good, bad=bad, good_metrics=good_obs, bad_metrics=bad_obs)


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a Hive-partitioned Parquet layer.

    Passing the layer schema pins partition-column types (``trade_date`` stays a
    DATE) and skips footer-based inference.  Filters on partition columns prune
    directories; other filters and the projection reach the Parquet reader.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    """S3: expose a DataFrame to SQL as a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def dim_table(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A small, fixed dimension as a DataFrame (for SQL users)."""
    return spark.createDataFrame(rows, schema)
