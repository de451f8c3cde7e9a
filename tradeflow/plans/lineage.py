"""Lineage cuts for intermediate results that several branches read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster configured; own one only on a local master where it is unset."""
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradeflow-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Compute ``df`` once and cut its lineage, for a result read by several branches.

    The rows are written as Parquet under ``path`` (default: the shared
    ``spark.checkpoint.dir``) - one pass, columnar, survives the loss of the
    executors that computed it - and read back, so every reader scans the
    stored copy instead of re-running the plan.
    """
    root = path or f"{shared_checkpoint_dir(df.sparkSession).rstrip('/')}/tradeflow"
    target = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL keys match each other; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        match = same if match is None else match & same
    return left.join(other, match, how).drop(*[f"__{k}" for k in keys])
