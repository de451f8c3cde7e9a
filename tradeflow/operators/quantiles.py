"""Exact discrete quantiles per group without ordering any group in one task.

``percentile_disc(q)`` is the value at position ``k = max(1, ceil(q * n))`` of
the group's sorted values.  A sketch with relative rank error ``e`` brackets
that value between its ``q - 2e`` and ``q + 2e`` quantiles; one pass then
counts the values below the bracket as one row and every distinct value inside
it (at most about ``4 e n`` per group), and a running count over those rows
finds position ``k``.  Ties collapse in the aggregation, and no group's values
meet in one task, so the result is exact whatever the sketch's error.  A NULL
group is a group of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.plans.lineage import join_null_safe

SKETCH_ACCURACY = 10_000


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float],
                    accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """One row per (group, prob): ``q`` and the exact discrete quantile ``value_q``."""
    eps = 1.0 / accuracy
    vals = df.select(group, value).filter(F.col(value).isNotNull())
    lows = [max(0.0, p - 2 * eps) for p in probs]
    highs = [min(1.0, p + 2 * eps) for p in probs]
    sketch = vals.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(value, lows, accuracy).alias("_lo"),
        F.percentile_approx(value, highs, accuracy).alias("_hi"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    brackets = sketch.select(
        group, "_n",
        F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("q"),
                               F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))).alias("_b"),
        "_min", "_max",
    ).select(
        group, "_n",
        F.col("_b.q").alias("q"),
        # the extreme sketch quantiles are widened to the true min / max
        F.when(F.col("_b.q") - 2 * eps <= 0, F.col("_min")).otherwise(F.col("_b.lo")).alias("_lo"),
        F.when(F.col("_b.q") + 2 * eps >= 1, F.col("_max")).otherwise(F.col("_b.hi")).alias("_hi"),
        F.greatest(F.lit(1), F.ceil(F.col("_b.q") * F.col("_n"))).alias("_k"),
    )
    tagged = join_null_safe(vals, brackets, [group])
    # values per bracket: everything below it is only counted, equal values inside it are one row
    inside = F.when(F.col(value) >= F.col("_lo"), F.col(value))
    steps = tagged.filter(F.col(value) <= F.col("_hi")).groupBy(group, "q", inside.alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_k").alias("_k"))
    w = Window.partitionBy(group, "q").orderBy(F.col("_v").asc_nulls_first())
    upto = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return steps.withColumn("_upto", upto).filter(
        F.col("_v").isNotNull() & (F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_c") < F.col("_k"))
    ).select(group, "q", F.col("_v").alias("value_q"))
