"""Operator 10, mixing sources to target weights by distributed prefix sums.

Every document gets a hash-random key (md5 of seed and id: the same on every
run).  Within each source documents are ranged by key: the key's leading hex
digits name a bucket, rows are ordered inside their bucket only, and the
buckets' totals are summed in order, so a source that holds a third of all
rows is spread over all its buckets.  The running total then cuts the order at
the source's exact budget; a budget over the source's size first repeats it
whole.

Targets: sources in code point order (null last) get the cycle of weights and
share ``share`` of all words by weight; no target exceeds ``most`` times its
source's size, the excess is shared again by weight among the others.

Defined cases: null text has size 0; a null source is a source of its own;
rows with a null id are keyed as the text "null"; repeated rows are separate
documents; a source without words has target 0; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm.common import free_name, stage, text_or_empty

WEIGHTS = (1, 2, 3)
MOST = 3
BUCKET_DIGITS = 2
BUCKET_ROWS = 50_000
#: sources whose names and limits are larger than this are joined, not broadcast
BROADCAST_BYTES = 32 << 20


def word_count(text: str = "text") -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.regexp_count(text_or_empty(text), F.lit("[^ \\t-\\r]+")).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source.

    Each round caps the sources above ``most`` times their size; the rounds
    run in one window over sources sorted by how early they are capped:
    with k sources capped, all others get ``weight * rest / other weights``,
    and a source is capped if its own limit lies below that.
    """
    # the table has one row per source: a list of names, far smaller than the corpus
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    named = totals.withColumn("weight", cycle.cast("long")).withColumn("limit", F.col("source_size") * most)
    early = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = early.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = F.sum("source_size").over(every) * F.lit(float(share))
    rest = total - F.coalesce(F.sum("limit").over(ahead), F.lit(0))
    others = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    level = named.withColumns({"rest": rest.cast("double"), "others": others.cast("double")})
    capped = F.col("limit") * F.col("others") <= F.col("weight") * F.col("rest")
    # the first source that is not capped sets the level of all that follow
    level = level.withColumn("free", ~capped)
    start = early.rowsBetween(Window.unboundedPreceding, 0)
    level = level.withColumns({
        "rest": F.first(F.when(F.col("free"), F.col("rest")), ignorenulls=True).over(start),
        "others": F.first(F.when(F.col("free"), F.col("others")), ignorenulls=True).over(start)})
    target = F.when(F.col("rest").isNull(), F.col("limit").cast("double")).otherwise(
        F.col("weight") * F.col("rest") / F.col("others"))
    return level.select("source", "source_size", target.alias("target"))


def mix_key(seed: str) -> Column:
    """The hash-random key that orders a source's documents."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, most: int = MOST,
        seed: str = "mix", cut: str = "words", row: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of ``docs`` (doc_id, text, source), and its copies.

    ``cut="words"``: the document at the cut is taken in part, so a source's
    words add up to its target rounded down.  ``cut="documents"``: it is taken
    whole if at least half of it fits (``taken`` is ``copies * size``).
    ``row`` names a column that tells rows apart; it orders rows of one key, and is returned too.
    """
    own = [row] if row else []
    sized = stage(docs.select("doc_id", "source", word_count().alias("size"), mix_key(seed).alias("key"), *own), "sizes")
    # null sources by a flag, so that joins are plain equalities
    sized = sized.withColumns({"known": F.col("source").isNotNull(), "name": F.coalesce("source", F.lit(""))})
    digits = max(BUCKET_DIGITS, len(f"{max(sized.count() // BUCKET_ROWS, 1):x}"))
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    sums = sized.groupBy("known", "name", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("known", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("known", "name", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"))
    totals = sums.groupBy("known", "name").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals.select(F.when(F.col("known"), F.col("name")).alias("source"), "source_size"),
                             weights, share, most)
    targets = targets.select(F.col("source").isNotNull().alias("known"), F.coalesce("source", F.lit("")).alias("name"),
                             "source_size", "target")
    # bucket rows carry their source's totals, so that documents join once, on a fine key
    ahead = ahead.join(targets, ["known", "name"])
    inside = Window.partitionBy("known", "name", "bucket").orderBy("key", *(own or ["size"])).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ahead, ["known", "name", "bucket"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("ahead") - F.col("inside")
    if cut == "words":
        last = F.greatest(F.least(rest, F.col("size")), F.lit(0))
        copies = epochs + F.when(last > 0, 1).otherwise(0)
    else:
        last = F.when(2 * rest >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        last = F.when(rest > 0, last).otherwise(F.lit(0))
        copies = epochs + F.when(last > 0, 1).otherwise(0)
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (epochs * F.col("size") + last).cast("long").alias("taken"), copies.cast("int").alias("copies"), epochs.cast("int").alias("epochs"), "key", *own)


def mix_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (whole documents), with all their columns.

    Planned row by row, because rows may share an id, or have none, in several
    sources; texts stay where they are.  A source takes its epochs of all rows
    and one more copy of the rows up to a last one in the order of keys, so one
    line a source tells every row its copies.
    """
    number, times = free_name(docs, "__row"), free_name(docs, "__copies")
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    plan = mix(rows.select("doc_id", "source", "text", F.col(number).alias("__row")), cut="documents", seed=seed, row="__row", **options)
    once_more = F.when(F.col("copies") > F.col("epochs"), F.struct("key", F.col("__row").alias("row")))
    limits = stage(plan.groupBy("source").agg(F.max("epochs").alias("epochs"), F.max(once_more).alias("last")), "limits")
    # a line a source: broadcast if the names are few, else an ordinary join
    size = limits.agg(F.count(F.lit(1)), F.sum(F.octet_length("source"))).first()
    limits = limits.select(F.struct("source", "epochs", "last").alias(times))
    if 100 * size[0] + (size[1] or 0) <= BROADCAST_BYTES:
        limits = F.broadcast(limits)
    placed = F.struct(mix_key(seed).alias("key"), F.col(number).alias("row"))
    again = F.coalesce(placed <= F.col(times)["last"], F.lit(False)) & text_or_empty().rlike("[^ \\t-\\r]")
    taken = rows.join(limits, F.col("source").eqNullSafe(F.col(times)["source"]))
    copies = F.array_repeat(F.lit(1), F.col(times)["epochs"] + again.cast("int"))
    return taken.withColumn(times, copies).withColumn(times, F.explode(times)).select(*docs.columns)
