"""Operator 11, byte-pair encoding and decoding by segment trees over pair ranks.

A text is cut into words by the vocabulary's split pattern (``transducer``
marks the cuts).  A word's symbols are the leaves of a segment tree: leaf i
holds the merge rank of the pair that symbol i forms with the next living
symbol, with i behind it, so that the root's minimum names the leftmost pair of
lowest rank.  Merging it changes three leaves (the pair, the one before it, and
the symbol that vanishes); each update climbs one path to the root.  The tree
is done when no leaf holds a mergeable pair.

Words of a batch are merged side by side: words of up to ``LANE`` symbols stand
as rows of one array of trees, all of which take their own root's merge in the
same step.  Longer words (an unbroken run of letters) have a tree of their own,
so one word of n symbols costs n log n steps at most and 40 bytes a symbol.
Merged words are kept by hash in a table of at most ``transducer.TABLE_MOST``.

Special strings inside texts become their ids, as in the library.  Texts with
characters whose class depends on the Unicode version are normalized and split
by the library; their words are merged here as all others.

Decoding joins the pieces of the ids: with spaces where the vocabulary names no
decoder, by bytes where it names the byte-level one (bytes that are no UTF-8
become U+FFFD).

Defined cases: null text is empty and has no ids; empty and blank texts have
none either; repeated rows are encoded alike; null ids decode to the empty
text; an id the vocabulary does not know adds nothing; other columns are not
read.  There is no shuffle.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import transducer
from tradeflow.llm.common import arrow_task, text_or_empty
from tradeflow.llm.textscan import SLICE, slices

#: symbols of the longest word that shares an array of trees
LANE = 64
#: trees merged side by side at once
LANES = 1 << 15
NEVER = np.int64(1) << 62
PLACE = 32


class Merges:
    """The merge table of a vocabulary file: ranks and results of symbol pairs."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
        keys = np.array([a << PLACE | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NEVER)
        self.ranks = np.append(np.array([r for r, _ in pairs.values()], np.int64)[order], 0)
        self.result = np.zeros(len(model["merges"]), np.int32)
        self.result[[r for r, _ in pairs.values()]] = [x for _, x in pairs.values()]
        self.pairs = pairs
        # a word's bytes as symbols; the last one carries the end-of-word suffix
        chars = byte_chars()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[chars[b] + suffix] for b in range(256)], np.int32)

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Tree keys of pairs: rank, then place; NEVER where the pair does not merge."""
        pair = left.astype(np.int64) << PLACE | right
        at = np.searchsorted(self.keys, pair)
        return np.where(self.keys[at] == pair, self.ranks[at] << PLACE | place, NEVER)


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merge_lanes(symbols: np.ndarray, sizes: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Merge words that stand as rows of ``symbols`` (padded, width a power of two): (symbols, living)."""
    rows, width = symbols.shape
    if not rows:
        return symbols, np.zeros((0, width), bool)
    every = np.arange(rows)
    # one more column on either side: the place before the first and past the last symbol
    place = np.arange(width, dtype=np.int32)
    living = place[None, :] < sizes[:, None]
    sym = np.full((rows, width + 1), -1, np.int32)
    sym[:, :width] = np.where(living, symbols, -1)
    after = np.tile(place + 1, (rows, 1))
    before = np.tile(np.append(place, width).astype(np.int32) - 1, (rows, 1))
    tree = np.full((rows, 2 * width), NEVER, np.int64)
    inside = place[None, :-1] + 1 < sizes[:, None]
    r, c = np.nonzero(inside)
    tree[r, width + c] = merges.leaves(sym[r, c], sym[r, c + 1], c)
    level = width
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    while True:
        top = tree[every, 1]
        every, top = every[top < NEVER], top[top < NEVER]
        if not len(every):
            return sym[:, :width], living
        at = (top & 0xFFFFFFFF).astype(np.int64)
        gone = after[every, at].astype(np.int64)
        beyond = after[every, gone].astype(np.int64)
        ahead = before[every, at].astype(np.int64)
        sym[every, at] = merges.result[top >> PLACE]
        sym[every, gone] = -1
        living[every, gone] = False
        after[every, at] = beyond
        before[every, beyond] = at
        follows = sym[every, beyond] >= 0
        tree[every, width + gone] = NEVER
        tree[every, width + at] = np.where(follows, merges.leaves(sym[every, at], sym[every, beyond], at), NEVER)
        first = ahead >= 0
        tree[every[first], width + ahead[first]] = merges.leaves(sym[every[first], ahead[first]], sym[every[first], at[first]], ahead[first])
        lane = np.concatenate([every, every, every[first]])
        node = width + np.concatenate([gone, at, ahead[first]])
        while node[0] > 1:  # all leaves lie at the same depth
            node = node >> 1
            tree[lane, node] = np.minimum(tree[lane, 2 * node], tree[lane, 2 * node + 1])


def merge_word(symbols: list[int], merges: Merges) -> list[int]:
    """Merge one long word by a segment tree of its own."""
    n, pairs, never = len(symbols), merges.pairs, int(NEVER)
    result = merges.result
    width = 1 << (n - 1).bit_length()
    sym = [*symbols, -1]
    after, before = list(range(1, n + 1)), list(range(-1, n))
    living = bytearray(b"\x01") * n

    def leaf(i: int, j: int) -> int:
        found = pairs.get((sym[i], sym[j]))
        return never if found is None else found[0] << PLACE | i

    tree = [never] * (2 * width)
    tree[width:width + n - 1] = [leaf(i, i + 1) for i in range(n - 1)]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def update(i: int, key: int) -> None:
        node = width + i
        tree[node] = key
        while node > 1:
            low, node = min(tree[node], tree[node ^ 1]), node >> 1
            if tree[node] == low:
                return
            tree[node] = low

    while tree[1] < never:
        at, rank = tree[1] & 0xFFFFFFFF, tree[1] >> PLACE
        gone = after[at]
        beyond = after[gone]
        sym[at] = int(result[rank])
        living[gone] = 0
        after[at] = beyond
        if beyond < n:
            before[beyond] = at
        update(gone, never)
        update(at, leaf(at, beyond) if beyond < n else never)
        if before[at] >= 0:
            update(before[at], leaf(before[at], at))
    return [s for s, alive in zip(sym, living) if alive]


def merge_words(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in order, number of ids of each); no word is empty."""
    sizes = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    symbols = merges.inner[data]
    symbols[ends - 1] = merges.last[data[ends - 1]]
    starts, counts = ends - sizes, np.zeros(len(words), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    width = 1
    while width <= LANE:
        chosen = np.flatnonzero((sizes <= width) & (sizes > width // 2))
        for rows in (chosen[i:i + LANES] for i in range(0, len(chosen), LANES)):
            at = np.minimum(starts[rows][:, None] + np.arange(width), len(symbols) - 1)
            merged, living = merge_lanes(symbols[at], sizes[rows], merges)
            counts[rows] = living.sum(axis=1)
            parts.append((np.repeat(rows, counts[rows]), merged[living]))
        width *= 2
    for row in np.flatnonzero(sizes > LANE).tolist():
        merged = merge_word(symbols[starts[row]:ends[row]].tolist(), merges)
        counts[row] = len(merged)
        parts.append((np.full(len(merged), row), np.array(merged, np.int32)))
    owner = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    ids = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int32)
    return ids[np.argsort(owner, kind="stable")], counts


class MergedWords(transducer.WordTokens):
    """Ids of words, remembered by hash; unknown words are merged by segment trees."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.clear()

    def look_up(self, hashes: np.ndarray, word_at) -> np.ndarray:
        if len(self.hashes) > transducer.TABLE_MOST:
            self.clear()
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != keys[inside]
        if new.any():
            ids, counts = merge_words([word_at(i).encode() for i in first[new].tolist()], self.merges)
            slots = np.arange(len(counts)) + len(self.starts) - 1
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.ids = np.concatenate([self.ids, ids])
            self.hashes = np.insert(self.hashes, at[new], keys[new])
            self.slots = np.insert(self.slots, at[new], slots)
            at = np.searchsorted(self.hashes, keys)
        return self.slots[at][back]


class Decoder:
    """Texts of ids, equal to the library's decoding with special strings kept."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_bytes = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        pieces: dict[int, str | bytes] = {i: s for s, i in vocab.items()} | {i: s for s, i in self.added.items()}
        if self.by_bytes:
            byte_of = {c: b for b, c in enumerate(byte_chars())}
            pieces = {i: s.encode() if s in self.added else bytes(byte_of[c] for c in s) for i, s in pieces.items()}
        self.pieces = pieces

    def text_of(self, ids: np.ndarray) -> str:
        found = [self.pieces[i] for i in ids.tolist() if i in self.pieces]
        return b"".join(found).decode("utf-8", "replace") if self.by_bytes else " ".join(found)


class Codec(transducer.Encoder, Decoder):
    """Ids of whole texts and texts of ids, equal to the library's."""

    def __init__(self, path: str, pattern: str):
        spec = _spec(path)
        Decoder.__init__(self, spec)
        self.path, self.special, self.dense = path, list(self.added), pattern == "dense"
        self.transducer = transducer.Transducer(transducer._dense if self.dense else transducer._spaced)
        self.classes = transducer.char_classes()
        self.merges = Merges(spec["model"])
        self.words = MergedWords(self.merges)
        self.cuts = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")")
        self.byte_of = str.maketrans({c: chr(b) for b, c in enumerate(byte_chars())})

    @cached_property
    def tokenizer(self):
        """The library's tokenizer, loaded for the first text with a character of unsure class."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        # special strings cut a text into parts that are encoded apart
        parts, owner, out = [], [], [[] for _ in texts]
        for i, text in enumerate(texts):
            for j, part in enumerate(self.cuts.split(text) if any(s in text for s in self.added) else (text,)):
                out[i].append(np.array([self.added[part]], np.int32) if j % 2 else None)
                if not j % 2:
                    parts.append(part)
                    owner.append((i, len(out[i]) - 1))
        ids, counts = self.encode(parts)
        for (i, j), end, n in zip(owner, np.cumsum(counts).tolist(), counts.tolist(), strict=True):
            out[i][j] = ids[end - n:end]
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order of text, number of ids of each), for texts without special strings."""
        ids, owners, unsure = [], [], set()
        for run in self._runs(texts):
            found, owner, apart = self._run(run)
            unsure.update(apart)
            ids.append(found)
            owners.append(owner)
        every = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        if unsure:
            keep = ~np.isin(owner, list(unsure))
            exact = {i: self._by_library_words(texts[i]) for i in sorted(unsure)}
            every = np.concatenate([every[keep], *exact.values()])
            owner = np.concatenate([owner[keep], *[np.full(len(x), i) for i, x in exact.items()]])
            order = np.argsort(owner, kind="stable")
            every, owner = every[order], owner[order]
        return every, np.bincount(owner, minlength=len(texts))[:len(texts)]

    def _by_library_words(self, text: str) -> np.ndarray:
        """Ids of a text that the library normalizes and splits."""
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        words = [w.translate(self.byte_of).encode("latin-1") for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text) if w]
        return merge_words(words, self.merges)[0]


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a vocabulary file; pattern ``spaced`` or ``dense``."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


_decoders: dict[str, Decoder] = {}


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    own = codec(path, pattern)
    for batch in batches:
        for part in slices(batch):
            ids = own.ids_of(transducer.texts_of(part["text"]))
            columns = [part["key"], pa.array([len(x) for x in ids], pa.int64()),
                       pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
            if decoded:
                columns.append(pa.array([own.text_of(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids", "decoded"][:len(columns)])


def decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    if path not in _decoders:
        _decoders[path] = Decoder(_spec(path))
    own = _decoders[path]
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch["ids"]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.unique(size // SLICE, return_index=True)[1].tolist()
        for part in (batch.slice(a, b - a) for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True)):
            texts = [own.text_of(np.frombuffer(ids or b"", "<u4")) for ids in part["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["key"], part["n_tokens"], part["ids"], pa.array(texts, pa.string())],
                                             names=["key", "n_tokens", "ids", "decoded"])


def encode(docs: DataFrame, path: str, pattern: str = "dense", key: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """``key``, n_tokens and ids (little-endian unsigned 32-bit integers as binary) of each row.

    ``decoded`` adds the text that the ids decode to, in the same task.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    schema = "key long, n_tokens long, ids binary" + (", decoded string" if decoded else "")
    return rows.mapInArrow(arrow_task(encode_batches, path=path, pattern=pattern, decoded=decoded), schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The rows of ``encode`` with their text, ``decoded``."""
    rows = encoded.select(F.col(key).cast("long").alias("key"), "n_tokens", "ids")
    return rows.mapInArrow(arrow_task(decode_batches, path=path),
                           "key long, n_tokens long, ids binary, decoded string").withColumnRenamed("key", key)
