"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the analytics rely on.  UTC matters: minute truncation and the
# markout's epoch-second frame assume instants are read in UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def make_session(app: str = "tradeflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` defaults to ``$SPARK_MASTER`` and then ``local[*]``; on a cluster
    leave it unset and let spark-submit decide.  Shuffle partitions are left to
    the caller / AQE: size them to the cluster, not to a laptop.
    """
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; ``fallback`` is only used when nothing is
    configured (tests), and is then also registered with the SparkContext.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
