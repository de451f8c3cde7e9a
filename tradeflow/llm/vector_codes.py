"""Operator 12, vector code compression: product codes by member-resident Lloyd rounds.

Vectors become integers (``floor(scale * x)``) and are cut into ``parts`` equal
consecutive parts.  Each part position has a codebook of up to ``entries``
entries, at first the parts of the vectors with the smallest keys.  A round
assigns every part to its position's nearest entry (squared distance, ties to
the lower index) and replaces an entry by the floor of its parts' mean; entries
without parts stay.  A last assignment gives the codes.

The parts live in partitions named by (position, entry, salt): an owner holds
the parts that an entry has.  In a round every partition measures its residents
against the new codebooks (broadcast: entries x dimension integers); those whose
entry stays the same stay where they are, and only those that change their
entry go through the shuffle, to the partitions of their new entry.  Stayers
and arrivals meet without an exchange, because both sides have the same
partitioner.  Owners then sum their residents, salts are added up by (position,
entry), and at most ``parts * entries`` sums reach the driver for the next
codebooks.  The number of salts grows with the table, so that an entry that
holds a third of all parts, or all of them, is spread over many owners.

Arrivals of each round are written to the checkpoint folder, so the loss of an
executor repeats narrow steps only: from the staged input and the checkpointed
arrivals.

Arithmetic is exact: distances are computed in double precision as long as
every intermediate value fits 53 bits, else in unbounded integers.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped; vectors shorter than the longest, and lengths that the parts do not
divide, are filled up with zeros; scaled components saturate at 32 bits (about
two million before scaling); keys that are null come last among the smallest
keys, equal keys go by their vector's components; with fewer vectors than
entries the codebooks are shorter; repeated rows are coded each on its own; an
error beyond 63 bits is null; an empty table gives no rows and empty codebooks;
other columns are carried along by ``carry`` only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import arrow_task, shared_folder, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: parts that one owner (position, entry, salt) holds at most, about, and parts of one partition
OWNER_PARTS, PARTITION_PARTS = 8192, 65_536
LOW, HIGH = -(1 << 31), (1 << 31) - 1
LONGEST = (1 << 63) - 1
#: rows measured at once
CHUNK = 8192


@dataclass(frozen=True)
class Codes:
    """Codes of the kept rows, and the final codebooks (positions x entries x width)."""

    rows: DataFrame  # the carried columns, codes array<int>, error long
    codebooks: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all entries' components by position, entry and place, as decimals with commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


#: partitions, entries a codebook, salts an entry
Layout = tuple[int, int, int]


def owner_of(layout: Layout, position: np.ndarray, entry: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """The partition of each part: that of its (position, entry, salt)."""
    partitions, entries, salts = (np.uint64(x) for x in layout)
    name = (position.astype(np.uint64) * entries + entry.astype(np.uint64)) * salts + _scramble(uid) % salts
    return (_scramble(name) % partitions).astype(np.int64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# A block is (positions, entries, uids, components): arrays over its parts.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _pack(block: Block) -> tuple[bytes, ...]:
    return tuple(np.ascontiguousarray(x).tobytes() for x in block)


def _unpack(raw: tuple[bytes, ...], width: int) -> Block:
    position, entry, uid, data = raw
    return (np.frombuffer(position, np.int16), np.frombuffer(entry, np.int32), np.frombuffer(uid, np.int64),
            np.frombuffer(data, np.int32).reshape(-1, width))


def nearest(data: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry of ``book``, squared distance or -1 beyond 63 bits) for each row; ties to the lower index."""
    index, error = np.zeros(len(data), np.int32), np.zeros(len(data), np.int64)
    most = max(int(np.abs(x.astype(np.int64)).max(initial=0)) for x in (data, book))
    exact = 4 * max(data.shape[1], 1) * most * most < 1 << 53
    for at in range(0, len(data), CHUNK):
        rows = data[at:at + CHUNK]
        if exact:
            x, c = rows.astype(np.float64), book.astype(np.float64)
            away = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
            found = away.argmin(axis=1)
            least = away[np.arange(len(rows)), found].astype(np.int64)
        else:
            x, c = rows.astype(object), book.astype(object)
            away = np.array([[sum(int(d) * int(d) for d in row - entry) for entry in c] for row in x], object).reshape(len(rows), len(c))
            found = np.array([min(range(len(c)), key=lambda i, row=row: (row[i], i)) for row in away], np.int64)
            least = np.array([row[i] if row[i] <= LONGEST else -1 for row, i in zip(away, found, strict=True)], np.int64)
        index[at:at + CHUNK], error[at:at + CHUNK] = found, least
    return index, error


def measure(block: Block, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(new entries, squared distances) of a block's parts."""
    position, _, _, data = block
    entry, error = np.zeros(len(position), np.int32), np.zeros(len(position), np.int64)
    for p in np.unique(position).tolist():
        own = position == p
        entry[own], error[own] = nearest(data[own], books[p])
    return entry, error


def first_batches(batches: Iterator[pa.RecordBatch], books, layout: Layout) -> Iterator[pa.RecordBatch]:
    """Parts of the integer vectors with their first entries, in blocks by partition."""
    cut = books.value
    parts, _, width = cut.shape
    for batch in batches:
        uid = batch["uid"].to_numpy()
        grid = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(uid), parts, width)
        position = np.tile(np.arange(parts, dtype=np.int16), len(uid))
        uid = np.repeat(uid, parts)
        data = grid.reshape(-1, width)
        entry, _ = measure((position, uid, uid, data), cut)
        records = list(_by_owner(layout, (position, entry, uid, data)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in records], pa.int64()), *[pa.array([r[i] for _, r in records], pa.binary()) for i in range(4)]],
            names=["owner", "position", "entry", "uid", "data"])


def _by_owner(layout: Layout, block: Block) -> Iterator[tuple[int, tuple[bytes, ...]]]:
    """A block's parts in blocks by the partition of their owners."""
    if not len(block[0]):
        return
    owner = owner_of(layout, *block[:3])
    order = np.argsort(owner, kind="stable")
    owners, starts = np.unique(owner[order], return_index=True)
    for k, rows in zip(owners.tolist(), np.split(order, starts[1:]), strict=True):
        yield k, _pack(tuple(x[rows] for x in block))


def _blocks(records: Iterator, width: int) -> Iterator[tuple[int, Block]]:
    """(partition, block) for a partition's records, in blocks of about CHUNK parts."""
    held, size = [], 0
    for number, raw in records:
        held.append(_unpack(raw, width))
        size += len(held[-1][0])
        if size >= CHUNK:
            yield number, tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield number, tuple(np.concatenate(x) for x in zip(*held, strict=True))


def floor_parts(vector: Column, scale: int, length: int) -> Column:
    """The integer vector of ``length`` components: scaled, rounded down, saturated, filled up with zeros."""
    scaled = F.transform(vector, lambda x: F.greatest(F.lit(float(LOW)), F.least(F.lit(float(HIGH)), F.floor(
        F.greatest(F.lit(-1e15), F.least(F.lit(1e15), x.cast("double") * scale))).cast("double"))).cast("int"))
    return F.concat(scaled, F.array_repeat(F.lit(0), F.lit(length) - F.size(vector)))


def compress_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", carry: Sequence[str] = (),
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                     owner_parts: int = OWNER_PARTS, partition_parts: int = PARTITION_PARTS) -> Codes:
    """Codes of the rows of ``df`` with a finite vector: ``key``, the ``carry`` columns, codes, error."""
    spark = df.sparkSession
    shared_folder(spark)  # arrivals are checkpointed there
    finite = F.forall(F.col(vector), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    kept = df.filter(F.col(vector).isNotNull()).filter(finite).select(
        F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(True).alias("carried"),
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("uid"), F.col(vector).alias("vector"))
    size = kept.agg(F.max(F.size("vector")).alias("length"), F.count(F.lit(1)).alias("n")).first()
    width = max(-(-(size["length"] or 0) // parts), 1)
    # uids are fixed by writing them once
    kept = stage(kept.withColumn("vector", floor_parts(F.col("vector"), scale, parts * width)), "vectors")
    first = kept.orderBy(F.col("key").asc_nulls_last(), "vector", "uid").limit(entries).select("vector").collect()
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    none = {"position": "int", "entry": "int", "error": "long"}
    codes = kept.select("uid", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "key", "carried")
    if len(first):
        layout = (max(spark.sparkContext.defaultParallelism, -(-size["n"] * parts // partition_parts)), len(first), -(-size["n"] // owner_parts))
        measured, books = _lloyd(kept, books, rounds, layout)
        codes = codes.unionByName(measured, allowMissingColumns=True)
    # one exchange brings a row's parts and its columns together
    met = F.sort_array(F.collect_list(F.when(F.col("position").isNotNull(), F.struct("position", "entry"))))
    row = F.first(F.when(F.col("position").isNull(), F.struct("key", "carried")), ignorenulls=True)
    rows = codes.groupBy("uid").agg(row.alias("row"), met.alias("met"), F.when(F.min("error") >= 0, F.try_sum("error")).alias("error"))
    own = [F.col("row.carried")[c].alias(c) for c in carry]
    return Codes(rows.select(F.col("row.key").alias(key), *own, F.transform("met", lambda x: x["entry"]).alias("codes"), "error"), books)


def _lloyd(kept: DataFrame, books: np.ndarray, rounds: int, layout: Layout) -> tuple[DataFrame, np.ndarray]:
    """The rounds: (uid, position, entry, error) of all parts after the last assignment, and the final codebooks."""
    spark, sc = kept.sparkSession, kept.sparkSession.sparkContext
    width, partitions = books.shape[2], layout[0]
    # one partitioner for all tables of parts: a record's key is the number of its partition
    number = lambda key: key
    sent = sc.broadcast(books.astype(np.int32))
    blocks = kept.select("uid", "vector").mapInArrow(
        arrow_task(first_batches, books=sent, layout=layout), "owner long, position binary, entry binary, uid binary, data binary")
    # the first assignment deals all parts to their owners
    resident = blocks.rdd.map(lambda r: (r[0], tuple(map(bytes, r[1:])))).partitionBy(partitions, number)
    resident.checkpoint()
    held = None
    for left in range(rounds, 0, -1):
        totals = resident.mapPartitions(arrow_task(owner_sums, width=width)).reduceByKey(lambda x, y: (x[0] + y[0], x[1] + y[1]))
        books = books.copy()
        for (position, entry), (count, total) in totals.collect():  # at most positions * entries rows
            books[position, entry] = [x // count for x in total]
        sent = sc.broadcast(books.astype(np.int32))
        if left == 1:
            break
        # residents are measured once; stayers keep their partition, the others travel
        marked = resident.mapPartitions(arrow_task(mark, books=sent, width=width), preservesPartitioning=True)
        marked = marked.persist(StorageLevel.MEMORY_AND_DISK)
        movers = marked.mapPartitions(arrow_task(moving, layout=layout, width=width)).partitionBy(partitions, number)
        movers.checkpoint()
        movers.count()
        resident = marked.mapPartitions(arrow_task(staying, width=width), preservesPartitioning=True).union(movers)
        if held is not None:
            held.unpersist()
        held = marked
    last = resident.mapPartitions(arrow_task(final, books=sent, width=width))
    measured = stage(spark.createDataFrame(last, "position binary, entry binary, uid binary, error binary").mapInArrow(
        arrow_task(coded_batches), "uid long, position int, entry int, error long"), "codes")
    if held is not None:
        held.unpersist()
    return measured, books


def owner_sums(records: Iterator, width: int):
    """((position, entry), (parts, sums of their components)) of the residents of a partition."""
    for _, (position, entry, _, data) in _blocks(records, width):
        name = position.astype(np.int64) << 32 | entry
        order = np.argsort(name, kind="stable")
        names, starts, counts = np.unique(name[order], return_index=True, return_counts=True)
        sums = np.add.reduceat(data[order].astype(np.int64), starts, axis=0)
        for key, count, total in zip(names.tolist(), counts.tolist(), sums, strict=True):
            yield (key >> 32, key & 0xFFFFFFFF), (count, total.astype(object))


def mark(records: Iterator, books, width: int):
    """Residents with the entry they have and, as fifth array, the one they get."""
    for number, block in _blocks(records, width):
        yield number, (*_pack(block), measure(block, books.value)[0].tobytes())


def _marked(records: Iterator, width: int) -> Iterator[tuple[int, Block, np.ndarray]]:
    for number, (*raw, new) in records:
        yield number, _unpack(tuple(raw), width), np.frombuffer(new, np.int32)


def staying(records: Iterator, width: int):
    for number, block, new in _marked(records, width):
        same = block[1] == new
        if same.any():
            yield number, _pack(tuple(x[same] for x in block))


def moving(records: Iterator, layout: Layout, width: int):
    for _, (position, entry, uid, data), new in _marked(records, width):
        away = entry != new
        yield from _by_owner(layout, (position[away], new[away], uid[away], data[away]))


def final(records: Iterator, books, width: int):
    for _, block in _blocks(records, width):
        entry, error = measure(block, books.value)
        yield _pack((block[0], entry, block[2], error))


def coded_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, position, entry, error) of blocks."""
    kinds = (("position", np.int16), ("entry", np.int32), ("uid", np.int64), ("error", np.int64))
    for batch in batches:
        for i in range(batch.num_rows):
            position, entry, uid, error = (np.frombuffer(batch[c][i].as_py(), t) for c, t in kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid), pa.array(position.astype(np.int32)), pa.array(entry), pa.array(error)], names=["uid", "position", "entry", "error"])
