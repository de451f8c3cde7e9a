"""Operator 3, best-fit packing: vector best-fit over length classes.

Pieces are vectors (tokens, one document, attention cost = tokens squared); a
sequence has a capacity in every dimension.  Vector best-fit decreasing takes
pieces from long to short and puts each into the open sequence that fits in
every dimension and scores best: smallest weighted norm of what would remain
(``rule="norm"``) or largest weighted dot product of piece and residual
(``rule="dot"``); else it opens a new sequence.

Equal pieces are interchangeable, so the choice is made for whole runs: open
sequences with equal residuals form one *class* with a contiguous range of
numbers, and a run of equal pieces goes to the best class, as many a sequence
as the rule would put there one after another.  The plan needs the number of
pieces of each length only (at most ``max_tokens`` rows, whatever the corpus
size) and gives the same packing as piece-by-piece best-fit over all pieces.

The pieces then find their place without meeting in one task: each gets its
rank among the pieces of its length (local row numbers in hashed buckets, plus
prefix sums over the table of bucket counts), and looks its rank up in the
plan's runs.  A length that holds a third of all pieces is spread over all
buckets.

Defined cases: null text is empty and becomes one piece that holds the end
id; longer documents are cut into full pieces; repeated rows are packed each
on its own (equal rows may swap places); an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm import transducer
from tradeflow.llm.common import arrow_task, stage, text_or_empty
from tradeflow.llm.textscan import slices

MAX_TOKENS = 4096
BUCKET_ROWS, LEAST_BUCKETS = 50_000, 64


@dataclass(frozen=True)
class Capacity:
    """What a sequence may hold; None: as much as full-length tokens imply, which never binds."""

    tokens: int = MAX_TOKENS
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    rule: str = "norm"

    def piece(self) -> int:
        """The longest piece that every dimension allows."""
        return min(self.tokens, math.isqrt(self.attention or self.tokens**2))

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.int64)


def piece_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Each document's ids and the end id, cut into pieces of ``size``."""
    encoder = transducer.encoder(path, pattern)
    for batch in batches:
        for part in slices(batch):
            ids, counts = encoder.encode(transducer.texts_of(part["text"]))
            doc, piece, start, length, crc = [], [], [], [], []
            at = 0
            for key, n in zip(part["doc_id"].to_pylist(), counts.tolist(), strict=True):
                own = np.append(ids[at:at + n], end_id).astype("<u4")
                at += n
                for i in range(0, n + 1, size):
                    cut = own[i:i + size]
                    doc.append(key)
                    piece.append(i // size)
                    start.append(i)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])


def plan_packing(lengths: dict[int, int], capacity: Capacity = Capacity()) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset, pieces a sequence), by length and rank."""
    full = capacity.vector()
    weights = np.array(capacity.weights) / full**2 if capacity.rule == "norm" else np.array(capacity.weights) / full
    residual, first, number = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sequences, runs = 0, []
    for length in sorted(lengths, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        left, rank = lengths[length], 0
        while left:
            fits = np.flatnonzero((residual >= need).all(axis=1))
            fresh = []  # classes of new residuals: (residual, first, number)
            if len(fits) and capacity.rule == "norm":
                score = (((residual[fits] - need) ** 2) * weights).sum(axis=1)
                for c in fits[np.lexsort((first[fits], score))].tolist():
                    # once chosen, a sequence only gets better: it takes all it can
                    each = int((residual[c] // need).min())
                    left, rank = _fill(runs, fresh, residual, first, number, c, need, each, left, rank, full)
                    if not left:
                        break
            elif len(fits):
                score = ((residual[fits] / full) * need * weights).sum(axis=1)
                c = int(fits[np.lexsort((first[fits], -score))[0]])
                left, rank = _fill(runs, fresh, residual, first, number, c, need, 1, left, rank, full)
            else:
                each = min(left, int((full // need).min()))
                count = left // each
                runs.append((length, rank, count * each, sequences, 0, each))
                fresh.append((full - each * need, sequences, count))
                sequences += count
                left -= count * each
                rank += count * each
            residual = np.concatenate([residual, [f[0] for f in fresh]])
            first = np.concatenate([first, [f[1] for f in fresh]])
            number = np.concatenate([number, [f[2] for f in fresh]])
            usable = (number > 0) & (residual > 0).all(axis=1)
            residual, first, number = residual[usable], first[usable], number[usable]
    return runs


def _fill(runs, fresh, residual, first, number, c, need, each, left, rank, full):
    """Put up to ``left`` pieces into class ``c``, ``each`` a sequence; split the class where they end."""
    offset = int(full[0] - residual[c][0])
    for per in (each, left % each if left < each * int(number[c]) else 0):
        count = min(left // per, int(number[c])) if per else 0
        if count:
            runs.append((int(need[0]), rank, count * per, int(first[c]), offset, per))
            fresh.append((residual[c] - per * need, int(first[c]), count))
            first[c] += count
            number[c] -= count
            left -= count * per
            rank += count * per
    return left, rank


def place_batches(batches: Iterator[pa.RecordBatch], runs) -> Iterator[pa.RecordBatch]:
    """sequence_id and offset of each piece from its rank among its length."""
    keys, rank, first, offset, each = runs.value
    for batch in batches:
        length = batch["length"].to_numpy(zero_copy_only=False)
        own = batch["rank"].to_numpy(zero_copy_only=False)
        at = np.searchsorted(keys, (length << 44) + own, "right") - 1
        step = own - rank[at]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(first[at] + step // each[at]), pa.array(offset[at] + step % each[at] * length)],
            names=[*batch.schema.names[:-1], "sequence_id", "offset"])


def pack(docs: DataFrame, path: str, pattern: str = "dense", end_id: int = 1, capacity: Capacity = Capacity()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pieces = stage(rows.mapInArrow(
        arrow_task(piece_batches, path=path, pattern=pattern, size=capacity.piece(), end_id=end_id),
        "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = np.array(plan_packing(lengths, capacity), np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    if len(runs) > 5_000_000:
        raise ValueError("the packing plan is too large to broadcast")
    table = docs.sparkSession.sparkContext.broadcast(
        ((runs[:, 0] << 44) + runs[:, 1], runs[:, 1].copy(), runs[:, 3].copy(), runs[:, 4].copy(), runs[:, 5].copy()))

    buckets = max(LEAST_BUCKETS, sum(lengths.values()) // BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("row", F.row_number().over(inside)).join(ahead, ["length", "bucket"]).select(
        *pieces.columns, (F.col("ahead") + F.col("row") - 1).alias("rank"))
    return ranked.mapInArrow(arrow_task(place_batches, runs=table),
                             "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
