"""Bucketed tables: layers whose files are dealt by a key, so that equal keys meet without an exchange (K2, K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_buckets(df: DataFrame, path: str, name: str, buckets: int, key: str, partitions: Sequence[str] = (),
                  sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in ``buckets`` buckets of ``key`` under ``path``, registered as ``name``.

    One exchange deals the rows by the bucket's own hash, so that every
    (partition, bucket) has one file.  ``sort_by`` orders rows inside the files.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.bucketBy(buckets, key).sortBy(key, *sort_by).saveAsTable(name)
    return spark.table(name)


def open_buckets(spark: SparkSession, path: str, name: str, buckets: int, key: str, schema_ddl: str,
                 partitions: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Register files of ``write_buckets`` in a session whose catalog does not know them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
    spark.sql(f"CREATE TABLE {name} ({schema_ddl}) USING parquet {by}CLUSTERED BY ({key}) "
              f"SORTED BY ({', '.join([key, *sort_by])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def replace_partitions(df: DataFrame, name: str, buckets: int, key: str) -> None:
    """Replace the partitions of table ``name`` that ``df`` holds; the files of all others stay."""
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(name).columns).repartition(buckets, key).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def colocating(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` in which joins on more columns than the bucket key still use the buckets.

    Plans are made when a DataFrame runs, so the setting belongs to a session of
    its own; catalog tables and the cluster are shared with ``spark``.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own
