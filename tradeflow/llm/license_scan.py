"""Operator 9, license scans by diagonal voting.

All rolling word 2-gram hashes of every text are joined to the positions of
the same 2-grams in short templates.  A match at word ``p`` of the text and
word ``q`` of the template votes for the diagonal ``p - q``: a copied passage
puts its votes on one diagonal, an edited one on a few neighbouring ones.
Votes are gathered per text, template and diagonal (in the scanning task first),
neighbouring diagonals are merged, and a span is verified by the share of the
template's positions that it holds, each counted once however often the text
repeats it, in the span's room.

Phrases are templates that must stand exactly: all their 2-grams on one
diagonal, that is every word in its place.

Nothing is grouped by a 2-gram, so a very common word pair is no hot key; the
groups are one text's votes.

Defined cases: null text is empty and gets 0 words and empty labels; repeated
rows are scanned each on its own (rows are told apart by a running number);
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.llm import textscan
from tradeflow.llm.common import arrow_task

GRAM = 2
#: diagonals this close belong to one passage
NEAR = 3
#: least share of a template's 2-grams in a verified span
LEAST_SHARE = 0.6

# Phrases that must stand exactly, with their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Licence notices, with their labels.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool


TEMPLATES = tuple([Template(a, b, True) for a, b in PHRASES] + [Template(a, b, False) for a, b in NOTICES])


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return textscan.words(texts, textscan.ALNUM, textscan.LOWER)


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(gram, template, place, grams, label, exact): a row per 2-gram of each template."""
    rows = []
    for t, template in enumerate(templates):
        hashes, _ = _word_hashes(pa.array([template.text]))
        keys = textscan.grams(hashes, GRAM).view(np.int64).tolist()
        if not keys:
            raise ValueError(f"template of fewer than {GRAM} words: {template.text}")
        rows += [(key, t, place, len(keys)) for place, key in enumerate(keys)]
    return spark.createDataFrame(rows, "gram long, template int, place int, grams int")


def gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and all rolling 2-gram hashes of each text."""
    for batch in batches:
        for part in textscan.slices(batch):
            hashes, counts = _word_hashes(part["text"])
            ends = np.cumsum(counts)
            keep = np.ones(max(len(hashes) - GRAM + 1, 0), bool)
            cut = ends[:-1] if len(ends) else ends  # a gram may not run into the next text
            for j in range(1, GRAM):
                at = cut - j
                keep[at[(at >= 0) & (at < len(keep))]] = False
            keys = textscan.grams(hashes, GRAM)[keep].view(np.int64)
            sizes = np.maximum(counts - GRAM + 1, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(keys))
            yield pa.RecordBatch.from_arrays([part["uid"], part["doc_id"], pa.array(counts, pa.int64()), lists],
                                             names=["uid", "doc_id", "n_words", "grams"])


def find_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Verified spans: uid, doc_id, n_words, template, first, past, share; one row with nulls for a text without."""
    known = template_grams(docs.sparkSession, templates)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    grams = rows.mapInArrow(arrow_task(gram_batches), "uid long, doc_id long, n_words long, grams array<long>")
    rolled = grams.select("uid", "doc_id", "n_words", F.posexplode_outer("grams").alias("at", "gram"))
    # the templates' 2-grams are a fixed short list
    votes = rolled.join(F.broadcast(known), "gram", "left").groupBy(
        "uid", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sort_array(F.collect_set("place")).alias("places"),
        F.max("grams").alias("grams"), F.min("at").alias("first"), F.max("at").alias("last"))
    exact = F.col("template").isin([t for t, x in enumerate(templates) if x.exact])
    order = Window.partitionBy("uid", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    begins = F.when(exact | gap.isNull() | (gap > NEAR), 1).otherwise(0)
    merged = votes.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(order)).groupBy(
        "uid", "template", "passage").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"),
        F.max("grams").alias("grams"), F.min("first").alias("first"), F.max("last").alias("last"))
    share = F.col("places") / F.col("grams")
    room = F.col("last") - F.col("first") + 1
    found = F.when(exact, F.col("places") == F.col("grams")).otherwise(
        (share >= LEAST_SHARE) & (room <= 2 * F.col("grams")))
    return merged.select(
        "uid", "doc_id", "n_words", *[F.when(found, c).alias(n) for n, c in (
            ("template", F.col("template")), ("first", F.col("first")), ("past", F.col("last") + GRAM), ("share", share))])


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``."""
    names = F.array(*[F.lit(t.label) for t in templates])
    exact = F.col("template").isin([t for t, x in enumerate(templates) if x.exact])
    label = F.get(names, F.col("template"))

    def joined(column):
        return F.array_join(F.sort_array(F.collect_set(column)), ",")

    return find_spans(docs, templates).groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count(F.when(exact, 1)).alias("n_base"),
        F.min(F.when(exact, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(exact, label)).alias("base_labels"), joined(label).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score")).drop("uid")
