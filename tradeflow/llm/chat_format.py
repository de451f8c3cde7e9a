"""Operator 2, chat formatting: token-level assembly of conversations.

Every turn becomes ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>``.
The three marks are reserved ids above the vocabulary; role and text are
encoded on their own, so no merge crosses a mark and no text can make one.
Control strings inside roles and texts are escaped first: a backslash goes
between ``<`` and ``|`` (one more if there are some already), which is undone
by taking one away.  Offsets of turns are prefix sums of their lengths over
the conversation, and the loss mask is the prefix sum of +1 where an
assistant's text begins and -1 where it ends.

``read_chats`` reads conversations back from ids and mask alone.

Defined cases: null role or text is empty; null turns come first, equal turns
are ordered by role and text; rows without a conversation id form one
conversation; repeated rows are repeated turns; other columns are not read.
A conversation is one output row, so it is held by one task, but no task
holds more than its own conversations one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm import transducer
from tradeflow.llm.common import arrow_task
from tradeflow.llm.textscan import slices

# Marks and the ids above byte_bpe_50k's 50,257.
MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
START, SEP, END = 50257, 50258, 50259


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))


def encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Adds the ids of role and text, each encoded on its own."""
    encoder = transducer.encoder(path, "spaced")
    for batch in batches:
        for part in slices(batch):
            lists = [_id_lists(*encoder.encode(transducer.texts_of(part[c]))) for c in ("role", "text")]
            yield pa.RecordBatch.from_arrays(
                [*[part[c] for c in ("conv_id", "place", "loss", "chars")], *lists],
                names=["conv_id", "place", "loss", "chars", "role_ids", "text_ids"])


def mask_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The loss mask: a running sum over +1 at span starts and -1 past span ends."""
    for batch in batches:
        masks = []
        for ids, spans in zip(batch["input_ids"], batch["spans"], strict=True):
            steps = np.zeros(len(ids) + 1, np.int8)
            for span in spans.as_py():
                steps[span["first"]] += 1
                steps[span["past"]] -= 1
            masks.append(np.cumsum(steps[:-1], dtype=np.int8))
        ends = np.concatenate([[0], np.cumsum([len(m) for m in masks])]).astype(np.int32)
        mask = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*masks, np.zeros(0, np.int8)])))
        yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["n_turns"], batch["formatted_chars"], batch["input_ids"], mask],
                                         names=["conv_id", "n_turns", "formatted_chars", "input_ids", "loss_mask"])


def format_chats(turns: DataFrame, path: str) -> DataFrame:
    """conv_id, n_turns, formatted_chars, input_ids, loss_mask for each conversation of ``turns``."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("place"),
        (role == "assistant").alias("loss"), escape(role).alias("role"), escape(text).alias("text"))
    marks = sum(map(len, MARKS))
    rows = rows.withColumn("chars", (F.length("role") + F.length("text") + marks).cast("long"))
    place = rows.schema["place"].dataType.simpleString()
    coded = rows.mapInArrow(arrow_task(encode_batches, path=path), f"conv_id long, place {place}, loss boolean, chars long, "
                            "role_ids array<int>, text_ids array<int>")
    size = F.size("role_ids") + F.size("text_ids") + 3
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(size).over(before), F.lit(0))
    text_at = F.col("at") + F.size("role_ids") + 2
    placed = coded.withColumn("at", offset).select(
        "conv_id", "chars", F.struct(
            "at", F.concat(F.array(F.lit(START)), "role_ids", F.array(F.lit(SEP)), "text_ids", F.array(F.lit(END))).alias("ids"),
            F.when(F.col("loss"), F.struct(text_at.alias("first"), (text_at + F.size("text_ids")).alias("past"))).alias("span"),
        ).alias("turn"))
    whole = placed.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("turn")).alias("turns"))
    spans = F.array_compact(F.transform("turns", lambda t: t["span"]))
    ready = whole.select("conv_id", "n_turns", "formatted_chars",
                         F.flatten(F.transform("turns", lambda t: t["ids"])).alias("input_ids"), spans.alias("spans"))
    return ready.mapInArrow(arrow_task(mask_batches), "conv_id long, n_turns long, formatted_chars long, "
                            "input_ids array<int>, loss_mask array<tinyint>")


def read_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Turns, the text under the mask and the formatted text, from ids and mask."""
    pieces = _id_bytes(path)

    def decode(ids) -> str:
        return b"".join(map(pieces.__getitem__, ids.tolist())).decode()

    for batch in batches:
        turns, loss, chars = [], [], []
        for ids, mask in zip(batch["input_ids"], batch["loss_mask"], strict=True):
            ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
            marks = [np.flatnonzero(ids == m).tolist() for m in (START, SEP, END)]
            turns.append([{"role": unescape(decode(ids[a + 1:b])), "text": unescape(decode(ids[b + 1:c]))}
                          for a, b, c in zip(*marks, strict=True)])
            edge = np.diff(np.concatenate([[0], mask, [0]]))
            loss.append("".join(unescape(decode(ids[a:b])) for a, b in zip(
                np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)))
            chars.append(len(decode(ids)))
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
             pa.array(loss, pa.string()), pa.array(chars, pa.int64())], names=["conv_id", "turns", "loss_text", "formatted_chars"])


def _id_bytes(path: str) -> list[bytes]:
    words = transducer.encoder(path, "spaced").words
    back = {chr(c): b for b, c in words.byte_chars.items()}
    vocabulary = words.tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (END + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(back[c] for c in token)
    for mark, i in zip(MARKS, (START, SEP, END), strict=True):
        out[i] = mark.encode()
    return out


def read_chats(formatted: DataFrame, path: str) -> DataFrame:
    """conv_id, turns (role and text), loss_text, formatted_chars: the inverse of ``format_chats``."""
    return formatted.select("conv_id", "input_ids", "loss_mask").mapInArrow(
        arrow_task(read_batches, path=path),
        "conv_id long, turns array<struct<role:string,text:string>>, loss_text string, formatted_chars long")
