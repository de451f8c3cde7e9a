"""Helpers shared by the operators: table access, staging and Arrow tasks."""

from __future__ import annotations

import contextlib
import gc
import importlib
import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# ASCII white space that separates words: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; own one only on a local master where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_noting: list[list[str]] = []


@contextlib.contextmanager
def noting(left: list[str]):
    """Add to ``left`` the folders of the tables that are staged meanwhile."""
    _noting.append(left)
    try:
        yield
    finally:
        _noting.remove(left)


def release(left: list[str], docs: DataFrame) -> None:
    """Remove the staged tables in ``left``, unless ``docs`` is still to be computed from any of them.

    Also lets go of the shuffle files of finished jobs.
    """
    read = docs.inputFiles()
    # a staged folder's name is unique, its path can be written in several ways
    if not any(os.path.basename(folder) in f for folder in left for f in read):
        for folder in left:
            _delete(docs.sparkSession, folder)
        left.clear()
    free_shuffles(docs.sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nobody holds any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts lineage: later jobs read files that survive the loss of executors.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for left in _noting:
        left.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the files of a staged table, once everything that reads it is written."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long column ``name`` that tells its rows apart, the same in every scan.

    Rows of Parquet files have the file's place among all (in the order of paths) in the upper
    bits and their own place in the file below, so nothing is written; rows of any other plan
    are staged first.
    """
    placed = _places(docs)
    if placed is None:
        docs = stage(docs, "rows")
        placed = _places(docs)
    path, row = placed
    paths = sorted(r[0] for r in docs.select(path).distinct().collect())  # a line a file
    file, at = free_name(docs, "__file"), free_name(docs, "__at")
    files = docs.sparkSession.createDataFrame(list(enumerate(paths)), f"`{at}` long, `{file}` string")
    return (docs.select("*", path.alias(file), row.alias(name)).join(F.broadcast(files), file)
            .withColumn(name, F.shiftleft(at, ROW_BITS) + F.col(name)).select(*docs.columns, name))


#: a file has fewer rows than 2 ** ROW_BITS
ROW_BITS = 40


def _places(docs: DataFrame) -> tuple[Column, Column] | None:
    """Path and row number of each row, if ``docs`` is a plain scan of Parquet files."""
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    try:
        file = docs.metadataColumn("_metadata")
        docs.select(file["file_path"], file["row_index"])
    except AnalysisException:
        return None
    return file["file_path"], file["row_index"]


def bitmap_bits(n: int, each: int = 32) -> int:
    """Bits (as a power of two) of a bitmap for ``n`` hashes: ``each`` a hash, 32 MB at most."""
    return min(28, max(20, (each * max(n, 1)).bit_length()))


def hash_bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bits that the values of the one column of ``hashes`` set in a bitmap of ``2 ** bits`` bits."""
    row = 32_768
    bit = hashes.select(F.pmod(F.col(hashes.columns[0]), F.lit(1 << bits)).alias("bit"))
    rows = bit.groupBy(F.floor(F.col("bit") / row).alias("row")).agg(
        F.bitmap_construct_agg(F.pmod("bit", F.lit(row))).alias("map")).collect()  # 2 ** bits / 8 bytes at most
    out = np.zeros(1 << bits >> 3, np.uint8)
    for r in rows:
        out[r["row"] * row // 8:][:row // 8] = np.frombuffer(r["map"], np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set: always for the hashes it was made of, seldom for others."""
    at = hashes & (len(bitmap) * 8 - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def sift_batches(batches: Iterator[pa.RecordBatch], kept, others, both: bool) -> Iterator[pa.RecordBatch]:
    """The rows that only the bitmap ``kept`` has (the last column is the hash), or those that both have."""
    for batch in batches:
        hashes = batch.columns[-1].to_numpy()
        other = in_bitmap(others.value, hashes)
        found = in_bitmap(kept.value, hashes) & (other if both else ~other)
        yield batch.filter(pa.array(found)).select(batch.schema.names[:-1])


def select_rows(rows: DataFrame, number: str, kept: DataFrame, others: DataFrame) -> DataFrame:
    """The rows whose ``number`` is in ``kept``; ``others`` has all other numbers (one column each).

    Wide rows stay in their tasks: bitmaps of both sets decide where only one of
    them has the number's hash, and only rows that both seem to have are joined.
    """
    spread = rows.sparkSession.sparkContext.broadcast
    maps = {name: spread(hash_bitmap(df.select(F.xxhash64(df.columns[0]).alias("hash")), bitmap_bits(df.count())))
            for name, df in (("kept", kept), ("others", others))}
    hashed = rows.withColumn(free_name(rows, "__hash"), F.xxhash64(number))
    sure, unsure = (hashed.mapInArrow(arrow_task(sift_batches, both=both, **maps), rows.schema) for both in (False, True))
    return sure.unionByName(unsure.join(kept.select(F.col(kept.columns[0]).alias(number)), number, "left_semi"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_task(target: Callable, **params) -> Callable:
    """A ``mapInArrow`` / ``applyInArrow`` function that calls ``target(batches, **params)``.

    Executors import the target's module, so its caches live as long as the
    Python worker; only ``params`` travel with the task.
    """
    module, name, root = target.__module__, target.__qualname__, ROOT

    def run(batches):
        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(batches, **params)

    return run


def group_task(target: Callable, **params) -> Callable:
    """An ``applyInArrow`` function that calls ``target(table, **params)`` on each group."""
    module, name, root = target.__module__, target.__qualname__, ROOT

    def run(table):
        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(table, **params)

    return run


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null, as an array (empty text: none)."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]
