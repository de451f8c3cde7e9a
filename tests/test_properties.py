"""Property tests: the chunked (bounded-partition) forms equal the plain windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradeflow.operators import bar_features, forward_mid

T0 = datetime(2024, 3, 1)

series = st.lists(
    st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 5 * 1440), st.integers(1, 500)),
    min_size=1, max_size=300,
)


def _bars(spark, rows):
    seen, out = set(), []
    for sym, minute, cents in rows:
        if (sym, minute) not in seen:  # bars are unique per (symbol, minute)
            seen.add((sym, minute))
            out.append((sym, T0 + timedelta(minutes=minute), cents / 100.0))
    return spark.createDataFrame(out, "symbol string, ts_min timestamp, mid_min double")


def _rows(df, cols):
    return sorted(tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v)
                        for v in r) for r in df.select(*cols).collect())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=series, chunk=st.integers(60, 130))
def test_chunked_features_equal_plain(spark, rows, chunk):
    bars = _bars(spark, rows)
    cols = ["symbol", "ts_min", "prev_mid", "log_return", "sma_20", "sma_60", "vol_20"]
    assert _rows(bar_features(bars, chunk_rows=chunk), cols) == _rows(bar_features(bars, chunk_rows=None), cols)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=series, chunk_minutes=st.integers(30, 300))
def test_chunked_markout_equals_plain(spark, rows, chunk_minutes):
    bars = _bars(spark, rows)
    cols = ["symbol", "ts_min", "fwd_mid"]
    chunked = forward_mid(bars, chunk_seconds=chunk_minutes * 60)
    assert _rows(chunked, cols) == _rows(forward_mid(bars, chunk_seconds=None), cols)
