"""Connected components of an edge table, by rounds of joins (no collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import free_shuffles, stage

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end ``u`` has one edge and is nobody's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    return not ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).filter("low + high > 1 and low > 0").count()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node it reaches.

    Alternating large-star and small-star rounds: every node's neighbours are
    hooked to the smallest one, so that long chains shrink in a logarithmic
    number of rounds.  Each round is written to the shared folder, and the
    shuffles before it are let go; a hub's rows are joined, never gathered.
    Edges that are stars already take no round.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v")
    # edges point from the larger to the smaller node
    now = stage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        free_shuffles(edges.sparkSession)
        if _stars(now):
            break
        # large star: larger neighbours of u hook to the least of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: u and its smaller neighbours hook to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = stage(small.filter("u != v").distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
