"""Structured Streaming forms of the ingest (S1, S6), the bar layer (N3) and its labels."""

from tradeflow.streaming.bars import start_bar_stream, stream_minute_bars
from tradeflow.streaming.labels import label_batch, start_label_stream

__all__ = ["label_batch", "start_bar_stream", "start_label_stream", "stream_minute_bars"]
