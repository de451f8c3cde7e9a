"""Operator 8, embedding near-dedup by NN-descent.

1. Equal vectors collapse into one *node* with a number of copies.
2. First lists: each node meets others in tables of random-hyperplane blocks
   (a block too full is cut by hashed salts) and keeps its ``k`` nearest.
   There are as many tables as a pair at the threshold needs to share a block
   with probability ``MEET``, and one of hashed blocks, in which every node
   meets others.
3. NN-descent: every node gathers its list and the ``k`` nearest of those that
   list it, all with vectors (a bounded row), compares these neighbours of its
   neighbours with each other, and hands out pairs that beat a member's list.
   Lists are merged and the step repeats until at most ``CHANGED`` of the
   entries are new.  Members that met at the same node before are not
   compared again.
4. Saturated lists, whose every entry is over the threshold, may hide links.
   They are enlarged to whole neighbourhoods: the components of threshold
   edges that hold a saturated node are compared inside, block against block,
   where tasks hold two blocks and give counts and a spanning forest, not
   pairs.  Two such components whose balls (a node and the largest angle to
   it) are near enough for a link are compared with each other as well.
5. Audit: hashed query nodes of every length are compared with all nodes in
   one pass, more of them until enough have links.  Recall is the mean over
   query nodes of the share of their links that was found, so a node of a pair
   counts as much as one of a crowd, and nodes with fewer than ``k`` others
   and crowds must both reach ``recall``.  If they do not, more blocks and
   steps follow; if they still do not, or too few query nodes have links to
   tell, all nodes are compared block against block, which is exact.

All cosines that decide a link are computed in double precision.

Defined cases: vectors that are null, zero, empty or hold null or non-finite
components link with nothing and are returned alone; vectors of different
length have no cosine; repeated rows are copies and link with each other; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import arrow_task, group_task, stage
from tradeflow.llm.graph import components

K = 10
COSINE = 0.9
#: hyperplane blocks: nodes wished for and allowed, and the probability that a pair at the threshold meets
WISHED, FULL, MEET = 1024, 4096, 0.98
BLOCK = 256
CHANGED, ROUNDS = 0.01, 3
RECALL = 0.98
#: the audit: query nodes at first and at most (broadcast), and how many of them with links in small groups it takes
QUERIES, MOST_QUERIES, LEAST_LINKED = 4096, 16384, 100
#: nodes of a block where all are compared
EXACT_BLOCK = 2048
#: regions compared in one task by their balls; rounding of angles, in radians
BALLS, SLACK = 1024, 1e-6
_PAIR = "array<struct<cos:double,node:long>>"


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors at unit length; null if empty, zero or not finite throughout."""
    for batch in batches:
        units = []
        for raw in batch["raw"]:
            v = raw.values.to_numpy(zero_copy_only=False).astype(float) if raw.is_valid else np.zeros(0)
            peak = np.abs(v).max(initial=0.0)
            if np.isfinite(v).all() and peak > 0:
                v = v / peak + 0.0  # squares neither overflow nor vanish; no negative zero
                units.append(v / np.sqrt(v @ v) + 0.0)
            else:
                units.append(None)
        yield pa.RecordBatch.from_arrays([batch["key"], pa.array(units, pa.list_(pa.float64()))], names=["key", "vec"])


def block_keys(batches: Iterator[pa.RecordBatch], tables: int, seed: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A key of ``bits`` hyperplane sides for each table, and one table of one key; vectors of one length a row."""
    for batch in batches:
        for part in _by_length(batch, "vec"):
            x = _vectors(part["vec"])
            if not len(x):
                continue
            planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], tables * bits))
            sides = (x @ planes > 0).reshape(len(x), tables, bits)
            keys = sides @ (1 << np.arange(bits)) if bits else np.zeros((len(x), tables), np.int64)
            keys = np.concatenate([keys, np.zeros((len(x), 1), np.int64)], axis=1)
            for t in range(tables + 1):
                yield pa.RecordBatch.from_arrays(
                    [part["node"], part["vec"], pa.array(np.full(len(x), t, np.int32)), pa.array(keys[:, t].astype(np.int64)),
                     pa.array(np.full(len(x), x.shape[1], np.int32))], names=["node", "vec", "table", "key", "dim"])


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    sizes = np.diff(batch[column].offsets.to_numpy())
    for n in np.unique(sizes).tolist():
        yield batch if (sizes == n).all() else batch.filter(pa.array(sizes == n))


def _best(sims: np.ndarray, nodes: np.ndarray, k: int) -> list[list[dict]]:
    """The ``k`` most similar other nodes of each row."""
    k = min(k, len(nodes))
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return [[{"cos": float(sims[i, j]), "node": int(nodes[j])} for j in row if sims[i, j] > -2] for i, row in enumerate(at)]


def block_lists(table: pa.Table, k: int) -> pa.Table:
    """Nearest nodes inside one block."""
    nodes = table["node"].to_numpy()
    x = _vectors(table["vec"].combine_chunks())
    lists = []
    for i in range(0, len(x), 512):
        sims = x[i:i + 512] @ x.T
        sims[np.arange(len(sims)), i + np.arange(len(sims))] = -9
        lists += _best(sims, nodes, k)
    return pa.table({"node": pa.array(nodes), "list": pa.array(lists, _pair_type())})


def _pair_type() -> pa.DataType:
    return pa.list_(pa.struct([("cos", pa.float64()), ("node", pa.int64())]))


def local_joins(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Pairs among each row's members, one of them fresh, that beat a member's worst entry and are not in its list."""
    for batch in batches:
        out_node, out_other, out_cos = [], [], []
        for members in batch["members"]:
            parts = members.values
            nodes = parts.field("node").to_numpy()
            if len(nodes) < 2:
                continue
            x = _vectors(parts.field("vec"))
            sims = x @ x.T
            worst = parts.field("worst").to_numpy()
            better = sims > worst[:, None]
            fresh = parts.field("fresh").to_numpy(zero_copy_only=False)
            better &= fresh[:, None] | fresh[None, :]
            np.fill_diagonal(better, False)
            have = parts.field("have")
            ends, flat = have.offsets.to_numpy(), have.flatten().to_numpy()
            for i in np.flatnonzero(better.any(axis=1)).tolist():
                own = flat[ends[i] - ends[0]:ends[i + 1] - ends[0]]
                new = [j for j in np.flatnonzero(better[i]).tolist() if nodes[j] not in own]
                out_node += [int(nodes[i])] * len(new)
                out_other += [int(nodes[j]) for j in new]
                out_cos += [float(sims[i, j]) for j in new]
        yield pa.RecordBatch.from_arrays([pa.array(out_node, pa.int64()), pa.array(out_other, pa.int64()),
                                          pa.array(out_cos, pa.float64())], names=["node", "other", "cos"])


def region_links(table: pa.Table, cosine: float, across: bool = False) -> pa.Table:
    """Link counts of each node inside one pair of blocks, and one link of a spanning forest each."""
    nodes, part, copies = (table[c].to_numpy() for c in ("node", "part", "copies"))
    x = _vectors(table["vec"].combine_chunks())
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if across or table["lo"][0].as_py() != table["hi"][0].as_py():
        linked &= part[:, None] != part[None, :]
    to = np.full(len(nodes), -1, np.int64)
    left = np.ones(len(nodes), bool)
    for start in range(len(nodes)):
        ahead = [start] if left[start] else []
        left[start] = False
        while ahead:
            i = ahead.pop()
            new = np.flatnonzero(linked[i] & left)
            left[new] = False
            to[new] = nodes[i]
            ahead += new.tolist()
    return pa.table({"node": pa.array(nodes), "links": pa.array((linked @ copies).astype(float)), "to": pa.array(to)})


def _angles(x: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x, -1.0, 1.0))


def head_angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The angle between each row's vector and its region's head."""
    for batch in batches:
        for part in _by_length(batch, "vec"):
            if len(part):
                angle = _angles(np.einsum("ij,ij->i", _vectors(part["vec"]), _vectors(part["head"])))
                yield pa.RecordBatch.from_arrays([part["component"], pa.array(angle)], names=["component", "angle"])


def ball_pairs(table: pa.Table, cosine: float) -> pa.Table:
    """Pairs of regions whose balls are near enough for a link, inside one pair of blocks."""
    nodes, part, radius = (table[c].to_numpy() for c in ("component", "part", "radius"))
    x = _vectors(table["head"].combine_chunks())
    near = _angles(x @ x.T) <= radius[:, None] + radius[None, :] + np.arccos(cosine) + SLACK
    if table["lo"][0].as_py() != table["hi"][0].as_py():
        near &= part[:, None] != part[None, :]
    i, j = np.nonzero(np.triu(near, 1))
    return pa.table({"a": pa.array(np.minimum(nodes[i], nodes[j])), "b": pa.array(np.maximum(nodes[i], nodes[j]))})


def near_ball(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows whose vector is near enough to the other region's ball for a link."""
    for batch in batches:
        for part in _by_length(batch, "vec"):
            if len(part):
                angle = _angles(np.einsum("ij,ij->i", _vectors(part["vec"]), _vectors(part["head"])))
                near = pa.array(angle <= part["radius"].to_numpy() + np.arccos(cosine) + SLACK)
                yield part.filter(near).select(["a", "b", "part", "node"])


def audit_batches(batches: Iterator[pa.RecordBatch], queries, cosine: float) -> Iterator[pa.RecordBatch]:
    """For each query node the true links (rows, and nodes) among this task's rows."""
    by_length = {x.shape[1]: (keys, x) for keys, x in queries.value}
    rows, others = ({n: np.zeros(len(keys)) for n, (keys, _) in by_length.items()} for _ in range(2))
    for batch in batches:
        for part in _by_length(batch, "vec"):
            own = _vectors(part["vec"]) if len(part) else np.zeros((0, 0))
            if own.shape[1] in by_length:
                keys, x = by_length[own.shape[1]]
                nodes, copies = part["node"].to_numpy(), part["copies"].to_numpy()
                for i in range(0, len(own), 1024):
                    linked = (own[i:i + 1024] @ x.T >= cosine) & (nodes[i:i + 1024, None] != keys[None, :])
                    rows[own.shape[1]] += copies[i:i + 1024] @ linked
                    others[own.shape[1]] += linked.sum(axis=0)
    for n, (keys, _) in by_length.items():
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array((rows[n] + 0.5).astype(np.int64)), pa.array(others[n].astype(np.int64))],
                                         names=["node", "true_links", "true_nodes"])


def query_links(pool: DataFrame, cosine: float, k: int) -> tuple[DataFrame, bool]:
    """(node, true_links, true_nodes) of hashed query nodes, and whether they can tell the recall of small groups."""
    spark, size = pool.sparkSession, QUERIES
    while True:
        picked = pool.orderBy(F.xxhash64("node"), "node").limit(size).select("node", "vec").collect()
        lengths = {len(r["vec"]) for r in picked}
        queries = spark.sparkContext.broadcast([(np.array([r["node"] for r in picked if len(r["vec"]) == n]),
                                                 np.array([r["vec"] for r in picked if len(r["vec"]) == n])) for n in sorted(lengths)])
        truth = stage(pool.mapInArrow(arrow_task(audit_batches, queries=queries, cosine=cosine), "node long, true_links long, true_nodes long")
                      .groupBy("node").agg(F.sum("true_links").alias("true_links"), F.sum("true_nodes").alias("true_nodes")), "truth")
        whole = len(picked) < size  # every node is a query node
        if whole or truth.filter(F.col("true_nodes").between(1, k - 1)).count() >= LEAST_LINKED:
            return truth, True
        if size >= MOST_QUERIES:
            return truth, False
        size *= 2


def measured_recall(truth: DataFrame, links: DataFrame, k: int) -> float:
    """The lower of the mean shares of links found, by query node, in small groups and in crowds (no links at all: 1)."""
    share = F.least("true_links", F.coalesce("links", F.lit(0))) / F.col("true_links")
    means = truth.filter("true_links > 0").join(links, "node", "left").groupBy(F.col("true_nodes") < k).agg(F.avg(share).alias("share"))
    return min((r["share"] for r in means.collect()), default=1.0)


def _merge(lists: DataFrame, k: int) -> DataFrame:
    """One list a node: its ``k`` best distinct entries; rows (node, cos, other)."""
    order = Window.partitionBy("node").orderBy(F.col("cos").desc(), "other")
    return (lists.groupBy("node", "other").agg(F.max("cos").alias("cos"))
            .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
            .groupBy("node").agg(F.collect_list(F.struct("cos", F.col("other").alias("node"))).alias("list")))


def _flat(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("list").alias("e")).select("node", F.col("e.node").alias("other"), "e.cos")


def block_plan(n: int, cosine: float) -> tuple[int, int]:
    """Hyperplanes of a table, and the tables in which a pair at the threshold meets with probability ``MEET``."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / WISHED))))
    meet = (1 - np.arccos(cosine) / np.pi) ** bits
    return bits, 1 if meet >= MEET else int(np.ceil(np.log1p(-MEET) / np.log1p(-meet)))


def first_lists(nodes: DataFrame, k: int, cosine: float, times: int, seed: int) -> DataFrame:
    """(node, other, cos) rows from blocks of hyperplane keys, ``times`` the tables of the plan."""
    bits, tables = block_plan(nodes.count(), cosine)
    keyed = nodes.select("node", "vec").mapInArrow(
        arrow_task(block_keys, tables=tables * times, seed=seed, bits=bits),
        "node long, vec array<double>, table int, key long, dim int")
    sizes = keyed.groupBy("table", "key", "dim").agg(F.count(F.lit(1)).alias("n"))
    deals = sizes.select("table", "key", "dim", F.ceil(F.col("n") / FULL).cast("int").alias("deals"))
    dealt = keyed.join(deals, ["table", "key", "dim"]).withColumn(
        "salt", F.pmod(F.xxhash64("node", "table", F.lit(seed)), F.col("deals")))
    lists = dealt.groupBy("table", "key", "dim", "salt").applyInArrow(
        group_task(block_lists, k=k), f"node long, list {_PAIR}")
    return _flat(lists)


def descend(nodes: DataFrame, lists: DataFrame, k: int, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """New (node, other, cos) rows from neighbours of neighbours, and the members (node, other) that met, less those of ``before``."""
    forward = _flat(lists)
    back = Window.partitionBy("other").orderBy(F.col("cos").desc(), "node")
    reverse = forward.withColumn("place", F.row_number().over(back)).filter(F.col("place") <= k).select(
        F.col("other").alias("node"), F.col("node").alias("other"))
    members = stage(forward.select("node", "other").unionByName(reverse).unionByName(
        nodes.select("node", F.col("node").alias("other"))).distinct(), "members")
    fresh = members.withColumn("fresh", F.lit(True))
    if before is not None:
        fresh = members.join(before.withColumn("met", F.lit(True)), ["node", "other"], "left").select(
            "node", "other", F.col("met").isNull().alias("fresh"))
        fresh = fresh.join(fresh.filter("fresh").select("node").distinct(), "node", "left_semi")
    known = nodes.select("node", "vec").join(lists, "node", "left").select(
        F.col("node").alias("other"), "vec", F.coalesce(F.transform("list", lambda e: e["node"]), F.array().cast("array<long>")).alias("have"),
        F.when(F.size("list") >= k, F.array_min(F.transform("list", lambda e: e["cos"]))).otherwise(F.lit(-2.0)).alias("worst"))
    gathered = fresh.join(known, "other").groupBy("node").agg(F.collect_list(
        F.struct(F.col("other").alias("node"), "vec", "have", "worst", "fresh")).alias("members"))
    # a row holds at most 2 k + 1 members
    return gathered.select("members").mapInArrow(arrow_task(local_joins, k=k), "node long, other long, cos double"), members


def settle(nodes: DataFrame, lists: DataFrame, k: int) -> tuple[DataFrame, list[float]]:
    """Lists after as many steps as it takes until few entries change, and the changed share of each step."""
    shares, members = [], None
    while not shares or shares[-1] > CHANGED:
        found, members = descend(nodes, lists, k, members)
        new = stage(_merge(_flat(lists).unionByName(found), k), "lists")
        changed = _flat(new).join(_flat(lists), ["node", "other"], "left_anti").count()
        shares.append(changed / max(new.agg(F.sum(F.size("list"))).first()[0] or 0, 1))
        lists = new
    return lists, shares


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, k: int = K,
                    recall: float = RECALL) -> tuple[DataFrame, dict]:
    """(key, n_links, component_id, kept) for each row, and the audit: measured recall, rounds, whether all nodes were
    compared, share of list entries that each step changed."""
    spark = rows.sparkSession
    base = rows.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("raw"))
    base = stage(base.mapInArrow(arrow_task(unit_batches), "key long, vec array<double>"), "units")
    classes = base.filter("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("first"))
    nodes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    pool = nodes.select("node", "vec", "copies")

    if not pool.take(1):
        return base.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"),
                           F.col("key").alias("component_id"), F.lit(True).alias("kept")), {"recall": 1.0, "rounds": 0, "exact": True, "changed": []}
    truth, telling = query_links(pool, cosine, k)

    lists, steps = None, []
    for round_ in range(ROUNDS):
        found = first_lists(pool, k, cosine, round_ + 1, seed=round_)
        lists = stage(_merge(found if lists is None else _flat(lists).unionByName(found), k), "lists")
        lists, changed = settle(pool, lists, k)
        steps += changed
        links, edges = threshold_links(pool, lists, cosine, k)
        measured = measured_recall(truth, links, k)
        if measured >= recall or not telling:
            break
    exact = not telling or measured < recall
    if exact:
        links, edges = all_links(pool, cosine)
        measured = measured_recall(truth, links, k)
    audit = {"recall": measured, "rounds": round_ + 1, "exact": exact, "changed": steps}

    whole = components(edges)
    named = nodes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(names, "component").join(links, "node", "left").select(
        "vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    linked = base.join(known, "vec").select("key", "n_links", "component_id")
    alone = base.filter("vec is null").select(
        "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    result = linked.unionByName(alone)
    return result.select(F.col("key").alias(key), "n_links", "component_id",
                         F.col("key").eqNullSafe(F.col("component_id")).alias("kept")), audit


def threshold_links(pool: DataFrame, lists: DataFrame, cosine: float, k: int) -> tuple[DataFrame, DataFrame]:
    """(node, links) counting linked rows of other nodes, and (a, b) edges that connect them."""
    directed = _flat(lists).filter(F.col("cos") >= cosine).select(F.col("node").alias("a"), F.col("other").alias("b"))
    both = stage(directed.unionByName(directed.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near")
    whole = stage(components(both), "regions")
    full = lists.filter((F.size("list") >= k) & (F.array_min(F.transform("list", lambda e: e["cos"])) >= cosine)).select("node")
    crowded = whole.join(full, "node", "left_semi").select("component").distinct()
    # lists that are not full of links have them all
    members = whole.join(crowded, "component", "left_semi")
    plain = both.join(members.select(F.col("node").alias("a")), "a", "left_anti").join(
        pool.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("links"))
    # the others' whole neighbourhoods are compared, block against block, and so are neighbourhoods near each other
    members = stage(members, "members")
    compared = stage(inside_links(members, pool, cosine, BLOCK).unionByName(across_links(members, pool, cosine)), "compared")
    counted = compared.groupBy("node").agg(F.sum("links").cast("long").alias("links"))
    edges = both.unionByName(compared.filter("to >= 0").select(F.col("node").alias("a"), F.col("to").alias("b"))).distinct()
    return stage(plain.unionByName(counted), "counts"), edges


def _cells(rows: DataFrame, name: str, by: list[str], block: int) -> DataFrame:
    """Rows dealt over blocks of about ``block`` inside ``by``, once for each pair (lo, hi) of blocks that holds them."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    return (rows.join(sizes, by)
            .withColumn("part", F.pmod(F.xxhash64(name), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).drop("blocks", "other"))


def inside_links(members: DataFrame, pool: DataFrame, cosine: float, block: int) -> DataFrame:
    """(node, links, to) of all pairs of nodes inside each component of ``members``."""
    return _cells(members, "node", ["component"], block).join(pool, "node").groupBy("component", "lo", "hi").applyInArrow(
        group_task(region_links, cosine=cosine), "node long, links double, to long")


def all_links(pool: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (a, b) edges that connect them, from all pairs of nodes."""
    compared = stage(inside_links(pool.select("node", F.size("vec").alias("component")), pool, cosine, EXACT_BLOCK)
                     .filter("links > 0 or to >= 0"), "all-links")
    return (compared.groupBy("node").agg(F.sum("links").cast("long").alias("links")),
            compared.filter("to >= 0").select(F.col("node").alias("a"), F.col("to").alias("b")).distinct())


def across_links(members: DataFrame, pool: DataFrame, cosine: float) -> DataFrame:
    """(node, links, to) of all pairs of nodes in different components of ``members``.

    Exact by the triangle inequality on angles: a component lies in a ball
    around its head (its smallest node).  Pairs of balls near enough for a link
    are found from the heads, and of those only the nodes near enough to the
    other ball are compared.
    """
    heads = pool.join(members.select("component").distinct(), F.col("node") == F.col("component")).select(
        "component", F.col("vec").alias("head"))
    angles = members.join(pool, "node").join(heads, "component").select("component", "vec", "head").mapInArrow(
        arrow_task(head_angles), "component long, angle double")
    balls = stage(heads.join(angles.groupBy("component").agg(F.max("angle").alias("radius")), "component"), "balls")
    pairs = stage(_cells(balls.withColumn("dim", F.size("head")), "component", ["dim"], BALLS).groupBy("dim", "lo", "hi").applyInArrow(
        group_task(ball_pairs, cosine=cosine), "a long, b long"), "pairs")
    sides = pairs.select("*", F.lit(0).alias("part"), F.col("a").alias("component"), F.col("b").alias("far")).unionByName(
        pairs.select("*", F.lit(1).alias("part"), F.col("b").alias("component"), F.col("a").alias("far")))
    aims = sides.join(balls.withColumnRenamed("component", "far"), "far")
    near = stage(members.join(aims, "component").join(pool.select("node", "vec"), "node").select(
        "a", "b", "part", "node", "vec", "head", "radius").mapInArrow(
        arrow_task(near_ball, cosine=cosine), "a long, b long, part int, node long"), "near-balls")
    blocks = near.groupBy("a", "b").agg(*[F.ceil(F.sum(F.when(F.col("part") == i, 1).otherwise(0)) / BLOCK).cast("int").alias(f"n{i}")
                                          for i in (0, 1)]).filter("n0 > 0 and n1 > 0")
    first = F.col("part") == 0
    dealt = near.join(blocks, ["a", "b"]).withColumns({
        "own": F.pmod(F.xxhash64("node"), F.when(first, F.col("n0")).otherwise(F.col("n1"))).cast("int"),
        "other": F.explode(F.sequence(F.lit(0), F.when(first, F.col("n1")).otherwise(F.col("n0")) - 1))})
    cells = dealt.select("a", "b", "node", "part", F.when(first, F.col("own")).otherwise(F.col("other")).alias("lo"),
                         F.when(first, F.col("other")).otherwise(F.col("own")).alias("hi"))
    return cells.join(pool, "node").groupBy("a", "b", "lo", "hi").applyInArrow(
        group_task(region_links, cosine=cosine, across=True), "node long, links double, to long")
