"""Partitioned Parquet sinks.

Partitioned writes go through a REBALANCE on the partition keys: rows of one
key land in the same tasks (few files per directory) while AQE splits a hot
key - one day or symbol holding a third of the data - across several tasks
and merges cold ones, so file sizes stay near the advisory partition size
whatever the skew.  No global ORDER BY feeds a write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_layer(df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "overwrite",
                sort_by: Sequence[str] = (), dynamic: bool = False, rebalance: bool = True) -> None:
    """K1/K2: write ``df`` as Parquet partitioned by ``keys``.

    ``sort_by`` orders rows inside each file (O5) so readers get time-ordered
    files and tighter min/max statistics; ``dynamic`` replaces only the
    partitions present in ``df`` instead of the whole dataset (D14).
    ``rebalance=False`` writes the rows from the tasks that hold them, for a
    ``df`` whose partitions are already cut by ``keys``.
    """
    keys = list(keys)
    out = df.hint("rebalance", *keys) if keys and rebalance else df
    if sort_by:
        out = out.sortWithinPartitions(*keys, *sort_by)
    writer = out.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)


def write_table(df: DataFrame, name: str, keys: Sequence[str] = (), mode: str = "overwrite") -> None:
    """K3: persist as a managed, partitioned Parquet table in the catalog."""
    keys = list(keys)
    out = df.hint("rebalance", *keys) if keys else df
    writer = out.write.mode(mode).format("parquet")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.saveAsTable(name)


def external_table_ddl(spark: SparkSession, name: str, path: str, schema_ddl: str,
                       keys: Sequence[str]) -> DataFrame:
    """K6: register existing partitioned files as a catalog table and discover partitions."""
    keys = list(keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema_ddl}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def partition_inventory(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """K4: per partition of a stored layer, its number of files and rows.

    Reads only the partition columns and the hidden file-path metadata; the
    aggregate runs on the executors.
    """
    keys = list(keys)
    return (
        spark.read.parquet(path)
        .select(*keys, F.col("_metadata.file_path").alias("_file"))
        .groupBy(*keys)
        .agg(F.count_distinct("_file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))
    )


def partition_folder(spark: SparkSession, **values: object) -> str:
    """The folder of a partition below its layer, as Spark names it (``key=value/...``, escaped; NULL has a name)."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(f"{k}={names.DEFAULT_PARTITION_NAME() if v is None else names.escapePathName(str(v))}" for k, v in values.items())


def remove_partitions(spark: SparkSession, path: str, partitions: Sequence[str]) -> None:
    """Delete the named partition folders (``key=value``) of a stored layer, on whatever store holds it."""
    jvm = spark.sparkContext._jvm
    for name in partitions:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
