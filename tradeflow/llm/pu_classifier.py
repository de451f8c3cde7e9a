"""Operator 7, quality classifier: positive-unlabelled learning.

A logistic model of a few text statistics is fitted to trusted positives and
the unlabelled web text: with class prior ``p`` the risk is

    p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))

where ``R(+)`` and ``R(-)`` are mean losses of calling texts good or bad.  The
second term estimates the risk on bad texts and is kept from going negative.
All training is over all documents: statistics are staged once (one row of
about 70 bytes a text), each Newton step is one aggregation of them into a few
hundred sums, and only those sums reach the driver.

The prior is the share of positives among the labelled training rows, or a
parameter.  Labels of the held-out fold (``crc32(doc_id as text) mod 5 = 0``)
are never read; label, language, source and id are no inputs of a score.

Defined cases: null text counts as empty and is scored; a null id is not held
out and has no label; repeated rows are scored alike (each counts in the
unlabelled text); repeated labels of one id count as the best; without any
positives the score is the prior for every text; other columns are passed
over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import textscan
from tradeflow.llm.common import arrow_task, stage
from tradeflow.llm.quality_rules import STOP_WORDS

#: bytes of text measured at once
SLICE = 2 << 20
FOLDS = 5
STEPS = 12
RIDGE = 1e-3
CLIP = 5.0
THRESHOLD = 0.3

# Byte classes whose shares are statistics.
_GROUPS = (b"#*$%&|<>", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b".,;:?", b"\n", b"@/\\_={}[]~^`")
_MEMBER = np.array([[b in group for b in range(256)] for group in _GROUPS])
FEATURES = ("symbols", "digits", "upper", "exclaims", "stops", "lines", "marks", "log_words", "word_bytes",
            "distinct", "pairs", "echo", "top", "function_words")


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; an empty text has zeros."""
    data, offsets = textscan.raw(texts)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    out = np.zeros((n, len(FEATURES)))
    d = data[offsets[0]:offsets[-1]]
    at = offsets - offsets[0]
    for j, member in enumerate(_MEMBER):
        total = np.concatenate([[0], np.cumsum(member[d], dtype=np.int64)])
        out[:, j] = (total[at[1:]] - total[at[:-1]]) / size
    hashes, counts = textscan.words(texts, textscan.SPACED, textscan.LOWER)
    stops = np.sort(textscan.words(pa.array([" ".join(STOP_WORDS)]), textscan.SPACED, textscan.LOWER)[0])
    known = stops[np.minimum(np.searchsorted(stops, hashes), len(stops) - 1)] == hashes
    echo = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    pairs = textscan.grams(hashes, 2)
    end = 0
    for i, k in enumerate(counts.tolist()):
        start, end = end, end + k
        if k:
            own = np.unique(hashes[start:end], return_counts=True)[1]
            out[i, 7:] = (np.log1p(k), size[i] / k, len(own) / k,
                          len(np.unique(pairs[start:end - 1])) / (k - 1) if k > 1 else 1.0,
                          echo[start + 1:end].mean() if k > 1 else 0.0, own.max() / k, known[start:end].mean())
    return out


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in textscan.slices(batch, limit=SLICE):
            yield pa.RecordBatch.from_arrays([part["doc_id"], _rows(text_features(part["text"]))], names=["doc_id", "x"])


def _rows(x: np.ndarray) -> pa.Array:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.float32).ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES)).astype(float)


@dataclass(frozen=True)
class Model:
    """Weights over standardised, clipped statistics; the last is the constant."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - np.array(self.mean)) / np.array(self.scale), -CLIP, CLIP)
        return np.hstack([z, np.ones((len(z), 1))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ np.array(self.weights), -40, 40)))


def sum_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums over this task's rows of what a Newton step needs, as (place, value) rows."""
    k = len(FEATURES) + 1
    total = np.zeros(4 + 3 * k + k * k)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = model.design(_matrix(batch["x"]))
        good = batch["positive"].to_numpy(zero_copy_only=False)
        z = x @ np.array(model.weights)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        bad_loss = np.logaddexp(0, z)  # the loss of calling a text bad
        total += np.concatenate([
            [len(x), good.sum(), bad_loss.sum(), bad_loss[good].sum()],
            x[good].sum(axis=0), p @ x, p[good] @ x[good], ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])


def _sums(staged: DataFrame, model: Model) -> np.ndarray:
    rows = staged.select("positive", "x").mapInArrow(arrow_task(sum_batches, model=model), "place long, value double")
    table = rows.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    return table["value"].to_numpy()[np.argsort(table["place"].to_numpy())]


def _risk(s: np.ndarray, w: np.ndarray, prior: float, k: int) -> tuple[float, float]:
    """(non-negative risk, its part on bad texts) from the sums at weights ``w``."""
    n, m = s[0], s[1]
    good_as_bad = s[3] / m
    good_as_good = good_as_bad - (s[4:4 + k] @ w) / m  # logistic loss: l(z) - l(-z) = -z
    bad = s[2] / n - prior * good_as_bad
    return prior * good_as_good + max(0.0, bad) + RIDGE / 2 * (w[:-1] @ w[:-1]), bad


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(staged: DataFrame, prior: float) -> Model:
    """Minimise the non-negative risk over staged rows (positive, x)."""
    k = len(FEATURES) + 1
    stats = staged.select(F.posexplode("x").alias("place", "value")).groupBy("place").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("scale")).collect()
    by_place = {r["place"]: (r["mean"], r["scale"] or 1.0) for r in stats}
    moments = [by_place.get(i, (0.0, 1.0)) for i in range(len(FEATURES))]
    start = np.zeros(k)
    start[-1] = np.log(prior / (1 - prior))

    def at(w: np.ndarray) -> Model:
        return Model(tuple(m for m, _ in moments), tuple(s for _, s in moments), tuple(w.tolist()), prior)

    w, model = start, at(start)
    s = _sums(staged, model)
    if not s[0] or not s[1]:
        return model
    risk, bad = _risk(s, w, prior, k)
    ridge = np.append(np.full(k - 1, RIDGE), 1e-9)
    for _ in range(STEPS):
        mean_good, unl, good = s[4:4 + k] / s[1], s[4 + k:4 + 2 * k] / s[0], s[4 + 2 * k:4 + 3 * k] / s[1]
        curve = s[4 + 3 * k:].reshape(k, k) / s[0] + np.diag(ridge)
        if bad >= 0:
            step = -np.linalg.solve(curve, unl - prior * mean_good + ridge * w)
        else:  # the risk on bad texts has gone negative: raise it again
            step = np.linalg.solve(curve, unl - prior * good) * 0.1
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        while True:
            new = at(w + step)
            s_new = _sums(staged, new)
            risk_new, bad_new = _risk(s_new, w + step, prior, k)
            if risk_new <= risk + 1e-12 or bad < 0 or np.abs(step).max() < 1e-3:
                break
            step = step / 2
        done = np.abs(step).max() < 1e-2 or abs(risk - risk_new) < 1e-6
        if risk_new > risk and bad >= 0:
            break
        w, model, s, risk, bad = w + step, new, s_new, risk_new, bad_new
        if done:
            break
    return model


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> tuple[Model, DataFrame]:
    """The model, and the staged statistics (doc_id, positive, x) of all rows of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    if prior is None:
        share = marked.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        prior = min(max(share if share is not None else 0.5, 0.02), 0.98)
    good = marked.filter("quality = 1").select("doc_id", F.lit(True).alias("positive"))
    features = rows.mapInArrow(arrow_task(feature_batches), "doc_id long, x array<float>")
    staged = stage(features.join(good, "doc_id", "left").select(
        "doc_id", F.coalesce("positive", F.lit(False)).alias("positive"), "x"), "features")
    return fit(staged, prior), staged


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.scores(_matrix(batch["x"])) if batch.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])


def keep_batches(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    """The rows whose text scores ``least`` or more, unchanged."""
    for batch in batches:
        for part in textscan.slices(batch, limit=SLICE):
            yield part.filter(pa.array(model.scores(text_features(part["text"])) >= least))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, prior: float | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    model, staged = train(docs, labels, prior)
    scored = staged.select("doc_id", "x").mapInArrow(arrow_task(score_batches, model=model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, prior: float | None = None) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""
    model, _ = train(docs, labels, prior)
    return docs.mapInArrow(arrow_task(keep_batches, model=model, least=threshold), docs.schema)
