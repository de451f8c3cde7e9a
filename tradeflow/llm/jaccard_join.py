"""Operator 4, n-gram Jaccard join: an exact metric-space join over pivots.

Documents are sets of distinct word shingles; 1 - Jaccard is a metric.  Two
texts link when ``100 * |intersection| >= percent * |union|``, that is within
the radius ``t = 1 - percent / 100``.

1. Equal sets collapse into one *class*, named by 64 bits of its set's hash
   (thousands of copies cost one row a task).
2. Sets that share nothing are all at distance 1, where the triangle
   inequality tells nothing apart, so loners go first: of a class's shingles
   with hashes in a fixed share ``SAMPLE`` of all values, those that no other
   class holds are counted (one partial aggregation by shingle).  A linked set
   lacks fewer than ``n - ceil(percent n / 100) + 1`` shingles of its partner,
   so a class with that many of its own links with nothing.  The rest give
   their whole sets, and the same count over all their shingles lets more go.
   The rest name their *anchors*: that many first shingles in one order, the
   commonest last.  Linked sets share an anchor, whatever the order is.  The
   smallest class at an anchor is its *pivot*.
3. Voronoi regions: every class is measured exactly against the pivots of its
   anchors, so each pivot has the region of the classes that can touch its
   anchors.  Classes within ``t`` of a pivot link to it: one row a class, not
   one a pair, even for thousands of near copies.
4. Regions whose members are all connected are done.  The others are joined
   inside: members are cut into rings of width ``t`` around the pivot.  By the
   triangle inequality linked sets lie in the same or neighbouring rings, so a
   member is replicated to its ring and the next one only.  A crowded pair of
   rings is cut again into hashed blocks of ``BLOCK`` members: those of its
   largest component meet the blocks of the others only, which also meet each
   other.  Tasks hold two blocks at most and report a spanning forest of their
   links.  Pairs already connected or outside the window are not compared.
5. Connected components of all links (``graph.components``).

The order of step 2 knows the ``COMMON_MOST`` commonest shingles (counted over
all remaining classes, 16 bytes each, broadcast) and takes the others by hash;
it steers cost and cannot change the result.

Defined cases: null or empty text has the empty set and links with nothing;
fewer than ``words`` words form one shingle; repeated rows and equal texts are
one class, each row is returned; other columns are not read.  Shingles and
classes are 64-bit hashes: a chance collision inside one compared pair is below
1e-12, one between classes is expected once at five billion different texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import textscan
from tradeflow.llm.common import arrow_task, bitmap_bits, free_shuffles, group_task, hash_bitmap, in_bitmap, stage, unstage
from tradeflow.llm.graph import components

WORDS, PERCENT = 5, 80
BLOCK = 128
#: share of the hash values whose shingles are counted in step 2
SAMPLE = 0.3
#: shingles of this many classes or more are ordered last; at most COMMON_MOST of them are broadcast
COMMON_LEAST, COMMON_MOST = 8, 200_000


def _identity(found: np.ndarray) -> int:
    """64 bits that equal sets share."""
    return int(textscan.mix(np.add.reduce(textscan.mix(found, 1), keepdims=True)).view(np.int64)[0]) if len(found) else 0


def allowance(n: int | Column, percent: int):
    """Shingles of a set of ``n`` that a linked set can lack, plus one."""
    return n - ((percent * n + 99) / 100).cast("long") + 1 if isinstance(n, Column) else n - -(-percent * n // 100) + 1


def sketch_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Class and set size of each text."""
    for batch in batches:
        for part in textscan.slices(batch):
            rows = [(_identity(found), len(found)) for found in textscan.shingle_sets(part["text"], words)]
            node, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(node, pa.int64()), pa.array(n, pa.int64())],
                                             names=["doc_id", "node", "n"])


def sample_batches(batches: Iterator[pa.RecordBatch], words: int, share: float) -> Iterator[pa.RecordBatch]:
    """(shingle, class) for shingles with small hashes; a batch gives each class once."""
    most = np.uint64(int(share * 2**64))
    for batch in batches:
        seen = set()
        for part in textscan.slices(batch):
            keys, nodes = [], []
            for found in textscan.shingle_sets(part["text"], words):
                node = _identity(found)
                if len(found) and node not in seen:
                    seen.add(node)
                    keys.append(found[:np.searchsorted(found, most)])
                    nodes.append(node)
            sizes = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)),
                 pa.array(np.repeat(np.array(nodes, np.int64), sizes))], names=["key", "node"])


def set_batches(batches: Iterator[pa.RecordBatch], words: int, wanted) -> Iterator[pa.RecordBatch]:
    """Class and whole set (in hash order) of each text whose document's hash is in the bitmap ``wanted``."""
    for batch in batches:
        chosen = batch.filter(pa.array(in_bitmap(wanted.value, batch["hash"].to_numpy())))
        for part in textscan.slices(chosen):
            found = list(textscan.shingle_sets(part["text"], words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_identity(x) for x in found], pa.int64()), _lists([x.view(np.int64) for x in found])],
                names=["node", "keys"])


def shared_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Classes with the shingles of their sets that the bitmap ``shared`` has."""
    for batch in batches:
        lists = batch["keys"]
        flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        held = in_bitmap(shared.value, flat)
        count = np.concatenate([[0], np.cumsum(held)])[ends - ends[0]].astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch["node"], batch["n"], pa.ListArray.from_arrays(pa.array(count), pa.array(flat[held]))],
                                         names=["node", "n", "keys"])


def anchor_batches(batches: Iterator[pa.RecordBatch], percent: int, common) -> Iterator[pa.RecordBatch]:
    """(class, anchor): each set's first shingles, those it holds alone before all others and the commonest last."""
    known, times = common.value
    for batch in batches:
        nodes, anchors = [], []
        for node, n, keys in zip(batch["node"].to_pylist(), batch["n"].to_pylist(), batch["keys"], strict=True):
            found = keys.values.to_numpy()
            rank = np.zeros(len(found), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                rank = np.where(known[at] == found, times[at], 0)
            # shingles that are not in the list come first, and are nobody else's
            first = found[np.lexsort((found, rank))[:max(allowance(n, percent) - (n - len(found)), 0)]]
            nodes.append(np.full(len(first), node))
            anchors.append(first)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*nodes, np.zeros(0, np.int64)])),
                                          pa.array(np.concatenate([*anchors, np.zeros(0, np.int64)]))], names=["node", "anchor"])


def _lists(parts) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))


def join_block(table: pa.Table, percent: int) -> pa.Table:
    """Links inside one cell (two rings or two blocks of one region), as a spanning forest.

    Rows: node, component so far (label), distance to the pivot, block (part),
    whether of the largest component (major), size of the set (n), its shared keys.
    """
    order = np.argsort(table["node"].to_numpy(), kind="stable")
    node, label, dist, part = (table[c].to_numpy()[order] for c in ("node", "label", "dist", "part"))
    major = table["major"].to_numpy()[order]
    lists = table["keys"].combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    start, stop = ends[order] - ends[0], ends[order + 1] - ends[0]
    size = table["n"].to_numpy()[order]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    flat_all = np.concatenate([flat[s:e] for s, e in zip(start, stop, strict=True)])
    owner = np.repeat(np.arange(len(node)), stop - start)
    by_key = np.argsort(flat_all, kind="stable")
    keys, owner = flat_all[by_key], owner[by_key]
    radius = (100 - percent) / 100 + 1e-9
    left, right = [], []
    # two blocks of others, or others (one of any pair) against the largest component
    two = not major.any() and len(np.unique(part)) > 1
    for i in np.flatnonzero(~major).tolist():
        own = flat[start[i]:stop[i]]
        lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        n = hi - lo
        hits = owner[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        shared = np.bincount(hits, minlength=len(node))
        linked = (100 * shared >= percent * (size + size[i] - shared)) & (label != label[i])
        linked &= np.abs(dist - dist[i]) <= radius
        if two:
            linked &= part != part[i]
        for j in np.flatnonzero(linked).tolist():
            a, b = root(int(label[i])), root(int(label[j]))
            if a != b:
                parent[a] = b
                left.append(int(node[i]))
                right.append(int(node[j]))
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _sociable(sets: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The rows of ``sets`` that hold few enough shingles alone; ``held`` has (key, node) for the shingles to count."""
    own = held.groupBy("key").agg(F.min("node").alias("node"), F.max("node").alias("last")).filter(
        "node = last").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return _few_alone(sets, own, percent)


def _few_alone(sets: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The rows of ``sets`` whose number of shingles held alone (``own``, by class) a linked set can lack."""
    return sets.join(own, "node", "left").filter(F.coalesce("own", F.lit(0)) < allowance(F.col("n"), percent))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stage(source.mapInArrow(arrow_task(sketch_batches, words=words), "doc_id long, node long, n long"), "sketch")

    # 1: classes of equal sets
    classes = stage(sketch.filter("n > 0").groupBy("node").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("first_doc")), "classes")

    # 2: classes without too many shingles of their own, with their whole sets
    sample = source.select("text").mapInArrow(arrow_task(sample_batches, words=words, share=SAMPLE), "key long, node long")
    wanted = stage(_sociable(classes, sample, percent).select("node", "n", "first_doc"), "candidates")
    # here and below: the shuffles so far are the largest, and not read again
    free_shuffles(docs.sparkSession)
    # a bitmap of their first documents tells the scan which texts to give; false hits fall out of the join
    spread = docs.sparkSession.sparkContext.broadcast
    firsts = spread(hash_bitmap(wanted.select(F.xxhash64("first_doc").alias("hash")), bitmap_bits(wanted.count())))
    sets = stage(
        source.select("text", F.xxhash64("doc_id").alias("hash"))
        .mapInArrow(arrow_task(set_batches, words=words, wanted=firsts), "node long, keys array<long>")
        .join(wanted.select("node", "n"), "node").dropDuplicates(["node"]).select("node", "n", "keys"), "sets")
    free_shuffles(docs.sparkSession)
    # one count of all shingles: how many a class holds alone, and those that several classes share
    held = sets.select(F.explode("keys").alias("key"), "node").groupBy("key").agg(
        F.min("node").alias("node"), F.max("node").alias("last"), F.count(F.lit(1)).alias("times"))
    alone = F.col("node") == F.col("last")
    told = stage(held.groupBy(alone.alias("alone"), F.when(alone, F.col("node")).otherwise(F.col("key")).alias("id")).agg(
        F.sum("times").alias("times")), "shingles")
    shared = told.filter("not alone")
    common = shared.filter(F.col("times") >= COMMON_LEAST).orderBy(F.col("times").desc(), "id").limit(COMMON_MOST).toArrow().sort_by("id")
    common = spread((common["id"].to_numpy(), common["times"].to_numpy()))
    # a shingle that a class holds alone meets no other: whole sets travel without those that a bitmap tells
    shared = spread(hash_bitmap(shared.select("id"), bitmap_bits(shared.count(), 16)))
    known = sets.mapInArrow(arrow_task(shared_batches, shared=shared), "node long, n long, keys array<long>")
    keys = stage(_few_alone(known, told.filter("alone").select(F.col("id").alias("node"), F.col("times").alias("own")), percent)
                 .select("node", "n", "keys"), "kept")
    unstage(sets)
    free_shuffles(docs.sparkSession)
    posts = keys.mapInArrow(arrow_task(anchor_batches, percent=percent, common=common), "node long, anchor long")
    shared = posts.groupBy("anchor").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("last > pivot")
    regions = stage(posts.join(shared.select("anchor", "pivot"), "anchor").select("pivot", "node").distinct(), "regions")
    free_shuffles(docs.sparkSession)

    # 3: distances to the pivots; a crowded pivot's set is dealt to several tasks
    crowd = regions.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
    deals = F.ceil(F.col("members") / block).cast("int")
    # the pivots' sets are renamed after the join, so that both joins read one shuffle of the sets
    pivots = crowd.withColumn("deals", deals).join(keys, F.col("pivot") == F.col("node")).select(
        "pivot", "members", "deals", F.col("n").alias("pivot_n"), F.col("keys").alias("pivot_keys"))
    pivots = pivots.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    others = (regions.filter("pivot != node").join(crowd, "pivot")
              .withColumn("deal", F.pmod(F.xxhash64("node"), deals).cast("int")).select("pivot", "node", "deal")
              .join(keys, "node"))
    inter = F.size(F.array_intersect("keys", "pivot_keys"))
    measured = stage(others.join(pivots, ["pivot", "deal"]).select(
        "pivot", "node", "members", inter.alias("inter"), (F.col("n") + F.col("pivot_n") - inter).alias("joint")), "measured")
    close = 100 * F.col("inter") >= percent * F.col("joint")
    links = measured.filter(close).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    near = stage(components(links), "near")

    # 4: regions that still have several components
    place = measured.select("pivot", "node", "members", (1 - F.col("inter") / F.col("joint")).alias("dist"))
    place = place.unionByName(crowd.select("pivot", F.col("pivot").alias("node"), "members", F.lit(0.0).alias("dist")))
    place = place.join(near, "node", "left").withColumn("label", F.coalesce("component", "node"))
    several = place.groupBy("pivot").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    radius = (100 - percent) / 100
    rings = (place.join(several.select("pivot"), "pivot", "left_semi")
             .withColumn("ring", F.floor(F.col("dist") / F.lit(radius) + F.lit(1e-9)).cast("int")))
    # a cell holds two neighbouring rings; its largest component (major) meets the others (minor), and they each other
    cells = rings.select("pivot", "node", "label", "dist", F.explode(F.array(F.col("ring"), F.col("ring") + 1)).alias("cell"))
    sizes = cells.groupBy("pivot", "cell", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("pivot", "cell").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
    sizes = sizes.filter(F.col("n") > F.col("top.n")).select(
        "pivot", "cell", F.col("top.label").alias("top"), F.ceil(F.col("top.n") / block).cast("int").alias("majors"),
        F.ceil((F.col("n") - F.col("top.n")) / block).cast("int").alias("minors"))
    cells = cells.join(sizes, ["pivot", "cell"]).withColumn("major", F.col("label") == F.col("top"))
    cells = cells.withColumn("part", F.pmod(
        F.xxhash64("node", "cell"), F.when(F.col("major"), F.col("majors")).otherwise(F.col("minors"))).cast("int"))

    def meetings(others):
        return F.transform(F.sequence(F.lit(0), others - 1), lambda other: F.struct(
            F.lit(True).alias("mixed"), F.when(F.col("major"), F.col("part")).otherwise(other).alias("lo"),
            F.when(F.col("major"), other).otherwise(F.col("part")).alias("hi")))

    among = F.transform(F.sequence(F.lit(0), F.col("minors") - 1), lambda other: F.struct(
        F.lit(False).alias("mixed"), F.least("part", other).alias("lo"), F.greatest("part", other).alias("hi")))
    meets = F.when(F.col("major"), meetings(F.col("minors"))).otherwise(F.concat(meetings(F.col("majors")), among))
    cells = cells.withColumn("meet", F.explode(meets)).select(
        "pivot", "cell", "meet.*", "node", "label", "dist", "major", "part")
    # dealt by block: a partitioning on pivot and cell alone would do for the groups, and keep a region in one task
    met = cells.join(keys, "node").repartition("pivot", "cell", "mixed", "lo", "hi")
    inside = met.groupBy("pivot", "cell", "mixed", "lo", "hi").applyInArrow(
        group_task(join_block, percent=percent), "a long, b long")
    more = stage(inside, "links")
    free_shuffles(docs.sparkSession)

    # 5: one component for all links
    whole = stage(components(links.unionByName(more)), "whole")
    named = classes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    known = named.join(first, "component").select("node", "component_id")
    return sketch.join(known, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
