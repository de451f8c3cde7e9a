"""Operator 6, URL filters: a broadcast trie over reversed host labels and path segments.

``build_trie`` compiles allow and block entries ``host/path`` into nested
maps: first the host's labels from the right (``org``, ``example``, ...),
then the path's segments.  The last segment of an entry is a prefix: the entry
``example.org/en/1`` also fits ``/en/100``.  A walk visits at most one node
per label and segment of the URL, so cost does not grow with the entries.

Longest match: more host labels win over fewer; on one host node the longest
path wins.  Equal entries with different verdicts are an error.  The trie is
broadcast, so the entry list is checked against ``MAX_ENTRIES`` (a filter
list is a parameter, not data; 1,000,000 entries are about 300 MB).

Defined cases: a null URL or one without ``://`` has empty host and path and
gets the default verdict; hosts are compared as they stand (port and user
included) with A-Z lower-cased; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.llm.common import arrow_task

MAX_ENTRIES = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Marks inside the trie; no host label or path segment is an int.
PATHS, ENDS = 0, 1


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def build_trie(entries: Iterable[tuple[str, str, str]]) -> dict:
    """Trie of ``(verdict, host, path)`` entries, verdict ``allow`` or ``block``."""
    root: dict = {}
    for n, (verdict, host, path) in enumerate(entries):
        if n >= MAX_ENTRIES:
            raise ValueError(f"more than {MAX_ENTRIES} entries: too many to broadcast")
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict}")
        host = host.translate(str.maketrans(UPPER, LOWER))
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(PATHS, {})
        *whole, last = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(ENDS, {})
        if ends.setdefault(last, (host + path, verdict))[1] != verdict:
            raise ValueError(f"{host}{path} is both allowed and blocked")
    return root


def _path_match(node: dict, path: str) -> tuple[str, str] | None:
    """The longest path entry below one host node that ``path`` starts with."""
    best = None
    for segment in path.split("/"):
        if ENDS in node:
            ends = node[ENDS]
            fitting = [p for p in ends if segment.startswith(p)] if len(ends) <= 16 else [
                segment[:k] for k in range(len(segment) + 1) if segment[:k] in ends]
            if fitting:
                best = ends[max(fitting, key=len)]
        node = node.get(segment)
        if node is None:
            break
    return best


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest matching entry, or None."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if PATHS in node:
            best = _path_match(node[PATHS], path) or best
    return best


def judge_batches(batches: Iterator[pa.RecordBatch], trie) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [match(trie.value, h, p) if h else None
                 for h, p in zip(batch["_host"].to_pylist(), batch["_path"].to_pylist(), strict=True)]
        arrays = [*batch.columns[:-2],
                  pa.array([f and f[0] for f in found], pa.string()), pa.array([f and f[1] for f in found], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-2], "rule", "verdict"])


def filter_urls(pages: DataFrame, entries: Iterable[tuple[str, str, str]], key: str = "page_id",
                url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, host, path, the matching rule (or null) and the verdict (the rule's, else ``default``)."""
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(entries))
    parts = pages.select(key, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
                         url_host(F.col(url)).alias("_host"), url_path(F.col(url)).alias("_path"))
    schema = T.StructType([*parts.schema.fields[:-2], T.StructField("rule", T.StringType()),
                           T.StructField("verdict", T.StringType())])
    judged = parts.mapInArrow(arrow_task(judge_batches, trie=trie), schema)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
