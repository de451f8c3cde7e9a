"""Operator 5, token counts: a compiled transducer over chunks of text.

The vocabulary's split pattern is compiled into a deterministic transducer
(``transducer``): chunks of a text fold into state maps side by side, a
parallel prefix scan composes the maps, and each chunk then emits its word
ends from its known start state.  A transition that ends a word emits the
word's number of tokens.  Byte-pair merges of one word have no small
automaton, so that annotation is taken from the library's own merges the first
time a worker meets the word, and kept in a table of at most ``TABLE_MOST``
words a worker (a full table is emptied, words are then asked again).

Texts with special strings or with characters whose class depends on the
Unicode version are counted by the library itself.  There is no shuffle.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); very long
texts are run in parts cut where white space begins, which never cuts a word;
repeated rows are counted alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import transducer
from tradeflow.llm.common import arrow_task, text_or_empty
from tradeflow.llm.textscan import slices


def count_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = transducer.encoder(path, pattern)
    for batch in batches:
        for part in slices(batch):
            _, counts = encoder.encode(transducer.texts_of(part["text"]))
            yield pa.RecordBatch.from_arrays([part["key"], part["n_bytes"], pa.array(counts, pa.int64())],
                                             names=["key", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, pattern: str = "spaced", limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit for each row; ``pattern`` names the vocabulary's split."""
    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(arrow_task(count_batches, path=path, pattern=pattern), "key long, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
