"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tradeflow.functions.columns import (
    case_map,
    col_of,
    epoch_seconds,
    minute_of,
    ratio_log,
    round_half_up,
    side_sign,
)

__all__ = [
    "case_map",
    "col_of",
    "epoch_seconds",
    "minute_of",
    "ratio_log",
    "round_half_up",
    "side_sign",
]
