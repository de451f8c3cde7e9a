"""Plan inspection helpers (T1), built on ``DataFrame.explain``."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def partition_filters(df: DataFrame) -> list[str]:
    """The non-empty ``PartitionFilters`` of every file scan in ``df``'s plan."""
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", explain_text(df))
    return [f for f in found if f.strip()]


def plan_has(df: DataFrame, node: str, mode: str = "formatted") -> int:
    """How many times ``node`` (e.g. 'Exchange', 'BroadcastHashJoin') appears in the plan."""
    return len(re.findall(re.escape(node), explain_text(df, mode)))
