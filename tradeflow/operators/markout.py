"""As-of forward lookup (J5 / W12): the mid ``minutes`` after each bar.

``fwd_mid`` is the mid of the latest bar at or before ``ts_min + minutes`` in
the same symbol - a RANGE frame ``[current, +minutes]`` and its last value.
Bars hold at most one row per (symbol, minute), so the frame is bounded.

For scale the window is not partitioned by symbol alone (a hot symbol would
be one task).  Time is cut into fixed chunks; each bar in the first
``minutes`` of a chunk is also copied, as read-only context, to the previous
chunk, whose last frames reach into it.  Every (symbol, chunk) window then
holds at most chunk/60 + minutes rows and the answer is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.functions import epoch_seconds

DAY_SECONDS = 86400


def forward_mid_over_symbol(minutes: int = 30, mid: str = "mid_min", order_col: str | None = None) -> Column:
    """The forward mid as a window expression over each symbol's whole series.

    For callers that already window bars by symbol alone (a proven-small bar
    set): it reuses that partitioning; with ``order_col`` naming an existing
    epoch-seconds column it reuses that sort as well.
    """
    order = F.col(order_col) if order_col else epoch_seconds("ts_min")
    w = Window.partitionBy("symbol").orderBy(order).rangeBetween(0, int(minutes) * 60)
    return F.last(mid).over(w)


def forward_mid(bars: DataFrame, minutes: int = 30, chunk_seconds: int | None = DAY_SECONDS,
                mid: str = "mid_min") -> DataFrame:
    """Add ``fwd_mid`` to (symbol, ts_min, mid) bars.

    ``chunk_seconds=None`` runs the plain per-symbol window (reference shape);
    otherwise the chunked exact form described above.
    """
    horizon = int(minutes) * 60
    sec = epoch_seconds("ts_min")
    if chunk_seconds is None:
        return bars.withColumn("fwd_mid", forward_mid_over_symbol(minutes, mid))
    if chunk_seconds < horizon:
        raise ValueError("chunk_seconds must be at least the horizon")
    width = F.lit(int(chunk_seconds))
    staged = bars.withColumns({"_sec": sec})
    staged = staged.withColumns({"_chunk": F.floor(F.col("_sec") / width)})
    # A bar in the first `horizon` seconds of its chunk is also context for the previous chunk.
    in_head = F.pmod(F.col("_sec"), width) < F.lit(horizon)
    staged = staged.withColumn(
        "_part",
        F.explode(F.when(in_head, F.array(F.col("_chunk"), F.col("_chunk") - 1))
                  .otherwise(F.array(F.col("_chunk")))),
    )
    w = Window.partitionBy("symbol", "_part").orderBy("_sec").rangeBetween(0, horizon)
    return (
        staged.withColumn("fwd_mid", F.last(mid).over(w))
        .filter(F.col("_part").eqNullSafe(F.col("_chunk")))  # a bar without a minute has no chunk
        .drop("_sec", "_chunk", "_part")
    )
