"""Words of Arrow text batches as 64-bit hashes, by numpy over the raw UTF-8 bytes.

A word's hash is a polynomial over its bytes, taken from one running sum, so
cost is a few passes over the bytes and no Python object is made per word.
Texts are scanned in pieces of about ``PIECE`` bytes cut between words, so
memory depends on the batch's word count only (16 bytes a word), also for one
very long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SLICE = 8 << 20

_rng = np.random.default_rng(20240501)
_CODE = _rng.integers(1, 2**64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

# [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower-cased
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def _power(name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 1), _BASE if name == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= PIECE + 1:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finish)."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch's rows in runs of about ``limit`` bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    _, offsets = raw(batch[column])
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _pieces(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE bytes that end between words or between texts."""
    start, stop = int(offsets[0]), int(offsets[-1])
    while start < stop:
        end = min(start + PIECE, stop)
        if end < stop:
            at = int(np.searchsorted(offsets, end, "right")) - 1
            if offsets[at] > start:
                end = int(offsets[at])
            else:
                gap = np.flatnonzero(~is_word[data[start:end]])
                while not len(gap) and end < stop:  # a word longer than a piece
                    more = min(end + PIECE, stop)
                    gap = np.flatnonzero(~is_word[data[end:more]]) + (end - start)
                    end = more
                if len(gap):
                    end = start + int(gap[-1]) + 1
        yield start, end
        start = end


def words(texts: pa.Array, is_word: np.ndarray = SPACED, fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts in order, number of words of each text)."""
    data, offsets = raw(texts)
    code = _CODE[fold]
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for start, end in _pieces(data, offsets, is_word):
        d = data[start:end]
        n = len(d)
        inside = is_word[d]
        edge = np.zeros(n + 1, bool)
        lo, hi = np.searchsorted(offsets, [start, end], "left")
        edge[offsets[lo:hi + 1][offsets[lo:hi + 1] <= end] - start] = True
        edge[0] = edge[n] = True
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        first, past = np.flatnonzero(fresh), np.flatnonzero(last) + 1
        if not len(first):
            continue
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(code[d] * _power("up", n), out=total[1:])
        h = (total[past] - total[first]) * _power("down", n)[first]
        hashes.append(mix(h + (past - first).astype(np.uint64)))
        counts += np.bincount(np.searchsorted(offsets, first + start, "right") - 1, minlength=len(counts))[:len(counts)]
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` neighbouring words, over all texts; runs across texts are for the caller to skip."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:n], k)
    for j in range(1, k):
        out = mix(out * np.uint64(3) + hashes[j:j + n])
    return out


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the distinct hashes of its ``k``-word runs, sorted, A-Z lower-cased.

    A text of fewer words has one for its whole sequence; one without words none.
    """
    hashes, counts = words(texts, SPACED, LOWER)
    runs = grams(hashes, k)
    ends = np.cumsum(counts)
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        start = end - n
        if n >= k:
            yield np.unique(runs[start:end - k + 1])
        elif n:
            yield grams(hashes[start:end], n)
        else:
            yield np.zeros(0, np.uint64)
