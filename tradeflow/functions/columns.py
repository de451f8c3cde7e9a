"""Scalar column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, places: int, scale: int = 18) -> Column:
    """Round to ``places`` decimals, half away from zero, engine-neutrally.

    Rounds the value as it prints (its shortest decimal form), not its binary
    expansion: 0.145 -> 0.15 and 18.681210495 -> 18.681210 at 6 places.  The
    cast to ``decimal(38, 18)`` parses the printed form exactly (no second
    rounding at a coarser scale), then HALF_UP rounding is exact.  Money
    magnitudes up to 1e20 fit; ANSI mode raises beyond that rather than
    returning a wrong number.  Returns a double.
    """
    return F.round(col_of(c).cast(f"decimal(38,{scale})"), places).cast("double")


def case_map(c: str | Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """Map the values of ``c`` through a small fixed dictionary as a CASE.

    For a handful of fixed entries a CASE beats a broadcast join: no
    exchange, no hash table, and it is code-generated with the projection.
    """
    src = col_of(c)
    expr = None
    for key, value in mapping.items():
        expr = (F.when(src == key, F.lit(value)) if expr is None
                else expr.when(src == key, F.lit(value)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def side_sign(c: str | Column = "side") -> Column:
    """BUY -> +1.0, SELL -> -1.0, anything else NULL."""
    src = col_of(c)
    return F.when(src == "BUY", F.lit(1.0)).when(src == "SELL", F.lit(-1.0))


def minute_of(c: str | Column = "ts") -> Column:
    """Truncate a timestamp to its minute."""
    return F.date_trunc("minute", col_of(c))


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since the epoch as a long, usable as a RANGE frame order key."""
    return F.unix_seconds(col_of(c).cast("timestamp"))


def ratio_log(num: str | Column, den: str | Column) -> Column:
    """ln(num / den); NULL for a zero/NULL denominator or a non-positive ratio.

    ANSI mode is kept on, so the division is a ``try_divide``.
    """
    return F.ln(F.try_divide(col_of(num), col_of(den)))
