"""Operator 13, source divergence audit: how far the sources of a language differ in their words.

Terms are runs of letters (A-Z, a-z and everything beyond ASCII, A-Z
lower-cased).  A language keeps the ``V`` terms that at least ``least_docs`` of
its documents hold.  Every group (language and source) and the language as a
whole gives each kept term the smoothed integer share
``p = 1 + scale * (count + 1) div (N + V)``, ``N`` being its kept words.  Two
distributions are compared term by term by ``f(p, q) = (p - q)^2 div q``.

1. Duplicate texts collapse: rows are named by (language, 128 bits of the
   text's hash); a text that many rows share becomes one text with a count for
   each source.  A task sends a text once, whatever number of copies it holds;
   texts without a second copy anywhere stay where they are and do not enter
   the exchange at all (a bounded bitmap of the hashes that repeat tells which;
   a false hit only sends a text that need not travel).
2. Each text is tokenized once.  Its term counts, and one for the document, are
   multiplied by the copies of each source and summed by (language, source,
   term), in the task first.
3. Pairs of sources are evaluated sparsely.  Absent terms all have the share
   ``1 + scale div (N + V)``, so that the sum over all kept terms is

       sum over a's terms of f(p_a, q0_b)          (by a histogram of counts)
     + sum over b's terms of f(p0_a, q_b)          (likewise)
     + sum over shared terms of f(p_a, q_b) - f(p_a, q0_b) - f(p0_a, q_b)
     + (V - |a| - |b| + |shared|) * f(p0_a, q0_b)

   and only terms that two sources share are joined.

All numbers are integers; the order of ties is UTF-8.  The result is a row per
(language, source, other source) and, for each group, its ``most_terms`` terms
of greatest excess over the language.

Defined cases: null text, language and source are ''; an empty text counts as
a document without terms; a group without kept terms has count 0 for each; a
language of one source has no pairs; where V is 0 pairs have value 0 and there
are no terms; repeated rows are documents of their own; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm import textscan
from tradeflow.llm.common import arrow_task, stage, text_or_empty

SCALE, LEAST_DOCS, MOST_TERMS = 1_000_000_000, 3, 200
#: bits of the bitmap of repeated hashes: 8 MB at any size
BITMAP_BITS = 26
BITMAP_ROW = 32_768
#: bytes of text counted at once
SLICE = 4 << 20

# [^\x00-\x40\x5B-\x60\x7B-\x7F]+
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[0x80:] = True


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(text number, term) of every run of letters in the texts that ``offsets`` cut from ``data``."""
    base = int(offsets[0])
    own = data[base:int(offsets[-1])]
    inside = LETTER[own]
    n = len(own)
    edge = np.zeros(n + 1, bool)
    edge[offsets - base] = True
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | edge[1:n]
    first = np.flatnonzero(fresh)
    # letters side by side are the terms joined; a term begins after the letters before it
    before = np.cumsum(inside, dtype=np.int64)
    ends = np.append(before[first] - 1, before[-1] if n else 0)
    terms = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(textscan.LOWER[own[inside]]))
    return np.searchsorted(offsets, first + base, "right") - 1, terms


def term_counts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, text numbers, places in terms, counts): how often each text holds each of its terms."""
    data, offsets = textscan.raw(texts)
    known, owners, places, counts = [], [], [], []
    size = 0
    for start, end in textscan._pieces(data, offsets, LETTER):
        lo, hi = int(np.searchsorted(offsets, start, "right")) - 1, int(np.searchsorted(offsets, end, "left"))
        owner, terms = _runs(data, np.clip(offsets[lo:hi + 1], start, end))
        found = terms.dictionary_encode()
        n = max(len(found.dictionary), 1)
        both, times = np.unique((owner + lo) * n + found.indices.to_numpy(), return_counts=True)
        known.append(found.dictionary)
        owners.append(both // n)
        places.append(both % n + size)
        counts.append(times)
        size += len(found.dictionary)
    if not known:
        none = np.zeros(0, np.int64)
        return pa.array([], pa.large_string()), none, none, none
    # pieces name their terms apart: name them together, and add up texts cut between pieces
    every = pa.concat_arrays(known).dictionary_encode()
    n = max(len(every.dictionary), 1)
    both = np.concatenate(owners) * n + every.indices.to_numpy()[np.concatenate(places)]
    both, back = np.unique(both, return_inverse=True)
    times = np.bincount(back, np.concatenate(counts), len(both)).astype(np.int64) if len(both) else np.zeros(0, np.int64)
    return every.dictionary, both // n, both % n, times


def _emit(lang: pa.Array, source: pa.Array, term: pa.Array, count, docs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [lang.cast(pa.string()), source.cast(pa.string()), term.cast(pa.string()), pa.array(count, pa.int64()), pa.array(docs, pa.int64())],
        names=["lang", "source", "term", "count", "docs"])


def _counted(texts: pa.Array, langs: pa.Array, sources: pa.Array, copies: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Group counts of texts, the i-th of which the next ``size[i]`` sources hold ``copies`` times each."""
    terms, text, place, times = term_counts(texts)
    # a row for each term of a text and each source that holds the text
    reach = size[text]
    row = np.repeat(np.arange(len(text)), reach)
    step = np.arange(len(row)) - np.repeat(np.cumsum(reach) - reach, reach)
    at = (np.cumsum(size) - size)[text[row]] + step
    langs, sources = pc.dictionary_encode(langs), pc.dictionary_encode(sources)
    n_terms, n_sources = max(len(terms), 1), max(len(sources.dictionary), 1)
    group = langs.indices.to_numpy()[text[row]].astype(np.int64) * n_sources + sources.indices.to_numpy()[at]
    both, back = np.unique(group * n_terms + place[row], return_inverse=True)
    held = copies[at]
    count, docs = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
    np.add.at(count, back, times[row] * held)
    np.add.at(docs, back, held)
    group, term = both // n_terms, both % n_terms
    return _emit(langs.dictionary.take(pa.array(group // n_sources)), sources.dictionary.take(pa.array(group % n_sources)),
                 terms.take(pa.array(term)), count, docs)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, docs) of texts with a list of sources and copies each."""
    for batch in batches:
        for part in textscan.slices(batch, limit=SLICE):
            flat = part["copies"].flatten()
            yield _counted(part["text"], part["lang"], flat.field("source"), flat.field("n").to_numpy(zero_copy_only=False),
                           np.diff(part["copies"].offsets.to_numpy().astype(np.int64)))


def _repeated(batch: pa.RecordBatch, bitmap, bits: int) -> np.ndarray:
    """Whether the bitmap has each row's hash."""
    at = batch["a"].to_numpy() & ((1 << bits) - 1)
    return (bitmap.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def alone_batches(batches: Iterator[pa.RecordBatch], bitmap, bits: int) -> Iterator[pa.RecordBatch]:
    """The counts of the texts that no other row holds."""
    for batch in batches:
        for part in textscan.slices(batch.filter(pa.array(~_repeated(batch, bitmap, bits))), limit=SLICE):
            one = np.ones(part.num_rows, np.int64)
            yield _counted(part["text"], part["lang"], part["source"], one, one)


def send_batches(batches: Iterator[pa.RecordBatch], bitmap, bits: int) -> Iterator[pa.RecordBatch]:
    """Of the texts that may repeat, one row for each source of the task; its text goes with the first of them."""
    sent: set[tuple] = set()
    for batch in batches:
        for part in textscan.slices(batch.filter(pa.array(_repeated(batch, bitmap, bits))), limit=SLICE):
            copies: dict[tuple, list] = {}
            for i, key in enumerate(zip(*(part[c].to_pylist() for c in ("lang", "a", "b", "source")), strict=True)):
                copies.setdefault(key, [i, 0])[1] += 1
            rows = [i for i, _ in copies.values()]
            first = []
            for lang, a, b, _ in copies:
                first.append((lang, a, b) not in sent)
                sent.add((lang, a, b))
            chosen = part.take(pa.array(rows, pa.int64()))
            text = pc.if_else(pa.array(first, pa.bool_()), chosen["text"], pa.scalar(None, chosen["text"].type))
            yield pa.RecordBatch.from_arrays(
                [chosen["lang"], chosen["a"], chosen["b"], chosen["source"], text, pa.array([n for _, n in copies.values()], pa.int64())],
                names=["lang", "a", "b", "source", "text", "n"])


def repeats_bitmap(keys: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits: those of the values ``a`` whose texts more than one row holds."""
    repeated = keys.groupBy("lang", "a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bit = repeated.select(F.pmod("a", F.lit(1 << bits)).alias("bit"))
    rows = bit.groupBy(F.floor(F.col("bit") / BITMAP_ROW).alias("row")).agg(
        F.bitmap_construct_agg(F.pmod("bit", F.lit(BITMAP_ROW))).alias("map"))
    # at most 2 ** bits / 32768 rows of 4 KB
    out = np.zeros(1 << bits >> 3, np.uint8)
    for row in rows.collect():
        out[row["row"] * BITMAP_ROW // 8:][:BITMAP_ROW // 8] = np.frombuffer(row["map"], np.uint8)
    return out


def group_terms(docs: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, source, term, count, docs): occurrences of each term and documents that hold it, in every group."""
    def own(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    rows = docs.select(own("lang"), own("source"), text_or_empty().cast("string").alias("text"))
    rows = rows.select("lang", "source", "text", F.xxhash64("text").alias("a"),
                       F.xxhash64(F.lit(29), F.col("text"), F.length("text")).alias("b"))
    bitmap = docs.sparkSession.sparkContext.broadcast(repeats_bitmap(rows.select("lang", "a", "b"), bits))

    known = {"bitmap": bitmap, "bits": bits}
    counted = "lang string, source string, term string, count long, docs long"
    alone = rows.select("lang", "source", "text", "a").mapInArrow(arrow_task(alone_batches, **known), counted)
    # a text's rows: at most one for each task and source
    sent = rows.mapInArrow(arrow_task(send_batches, **known), "lang string, a long, b long, source string, text string, n long")
    several = sent.groupBy("lang", "a", "b").agg(
        F.max("text").alias("text"), F.collect_list(F.struct("source", "n")).alias("copies")).select("lang", "text", "copies")
    both = alone.unionByName(several.mapInArrow(arrow_task(count_batches), counted))
    return both.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column, scale: int) -> Column:
    """``1 + scale * (count + 1) div (total + terms)``, exact."""
    wide = ((count + 1).cast("decimal(20,0)") * F.lit(scale).cast("decimal(11,0)")).alias("wide")
    return F.lit(1) + F.call_function("div", wide, (total + terms).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    """``(p - q)^2 div q``"""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, scale: int = SCALE, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank for each pair of sources and each group's leading terms."""
    spark = docs.sparkSession
    per_term = Window.partitionBy("lang", "term")  # a row for each source at most
    terms = group_terms(docs).withColumns({"held": F.sum("docs").over(per_term), "lang_count": F.sum("count").over(per_term)})
    terms = stage(terms.filter(F.col("held") >= least_docs).select("lang", "source", "term", "count", "lang_count"), "terms")

    # one row a language, one row a group
    single = terms.groupBy("lang", "term").agg(F.first("lang_count").alias("count"))
    langs = single.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("count").alias("lang_n"))
    sizes = terms.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("own_terms"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = F.lit(0).cast("long")
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "own_terms", "v", "lang_n")])
    groups = stage(groups.withColumn("p0", F.when(F.col("v") > 0, share(zero, F.col("n"), F.col("v"), scale)).otherwise(F.lit(1))), "groups")

    p = share(F.col("count"), F.col("n"), F.col("v"), scale)
    q = share(F.col("lang_count"), F.col("lang_n"), F.col("v"), scale)
    known = stage(terms.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "count", p.alias("p"), q.alias("q"), "p0"), "shares")

    order = [F.col("value").desc(), F.col("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    leading = known.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                           distance(F.col("p"), F.col("q")).alias("value"))
    leading = leading.withColumn("rank", rank).filter(F.col("rank") <= most_terms)

    # every two sources of a language, as the result has them
    a, b = groups.alias("a"), groups.alias("b")
    pairs = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item"),
        F.col("a.p0").alias("p0"), F.col("b.p0").alias("q0"), F.col("a.v").alias("v"),
        (F.col("a.own_terms") + F.col("b.own_terms")).alias("own_terms"))
    absent = pairs.select("lang", "source", "item", (F.col("v") - F.col("own_terms")).alias("missing"),
                          distance(F.col("p0"), F.col("q0")).alias("both_absent"), zero.alias("value"))
    levels = known.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    here = levels.join(pairs, ["lang", "source"]).select(
        "lang", "source", "item", (F.col("times") * distance(F.col("p"), F.col("q0"))).alias("value"))
    there = levels.withColumnRenamed("source", "item").join(pairs, ["lang", "item"]).select(
        "lang", "source", "item", (F.col("times") * distance(F.col("p0"), F.col("p"))).alias("value"))
    x, y = known.alias("x"), known.alias("y")
    shared = x.join(y, (F.col("x.lang") == F.col("y.lang")) & (F.col("x.term") == F.col("y.term")) & (F.col("x.source") != F.col("y.source")))
    xp, yp, x0, y0 = F.col("x.p"), F.col("y.p"), F.col("x.p0"), F.col("y.p0")
    shared = shared.select(F.col("x.lang").alias("lang"), F.col("x.source").alias("source"), F.col("y.source").alias("item"),
                           F.lit(1).cast("long").alias("missing"),
                           (distance(xp, yp) - distance(xp, y0) - distance(x0, yp)).alias("value"))
    shared = shared.groupBy("lang", "source", "item").agg(F.sum("missing").alias("missing"), F.sum("value").alias("value"))
    none = F.lit(None).cast("long")
    parts = absent
    for other in (here.withColumns({"missing": zero, "both_absent": none}), there.withColumns({"missing": zero, "both_absent": none}),
                  shared.withColumn("both_absent", none)):
        parts = parts.unionByName(other)
    total = F.sum("value") + F.sum("missing") * F.max("both_absent")
    summed = parts.groupBy("lang", "source", "item").agg(total.alias("value"))
    compared = summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", rank)
    return compared.unionByName(leading)
