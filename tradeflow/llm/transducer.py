"""Finite-state pre-tokenizers, run in chunks, and their words' tokens.

The split patterns of the two public BPE vocabularies are compiled here into
deterministic transducers over a small alphabet of character classes.  A
transition emits up to two marks: a word starts at this character, or (known
one character late) at the one before.  The tokens of the word that a mark
closes are the transition's emission.

Running: a transition function of states is a *state map*.  The maps that
strings can have form a small monoid, compiled into one table.  A text is cut
into chunks; all chunks fold their characters into one map each, side by
side; a parallel prefix scan composes the maps; then every chunk knows its
start state and all chunks emit side by side.

Which characters are letters, numbers or white space follows Unicode; texts
with characters whose class may differ between Unicode versions, and texts
with special strings, go to the library itself.
"""

from __future__ import annotations

import os
import sys
import unicodedata

import numpy as np
import pyarrow as pa

from tradeflow.llm.textscan import mix

CHUNK = 64
PIECE = 1 << 20
TABLE_MOST = 2_000_000

# Character classes.  Letters that contractions need have their own.
SP, WS, AP, L, N, O, S1, R, V, E, LL, UNSURE = range(12)
# Unicode White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTERS = (L, S1, R, V, E, LL)
# Contractions 's 't 'm 'd 're 've 'll: the one-letter ones share class S1.
PAIRS = {R: E, V: E, LL: LL}

START, IN_SP, IN_WS, IN_L, IN_N, IN_O, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(10)
PENDING = {R: QUOTE_R, V: QUOTE_V, LL: QUOTE_L}
HERE, BEFORE = 1, 2


def char_classes() -> np.ndarray:
    """The class of every code point."""
    old = unicodedata.ucd_3_2_0
    out = np.full(0x110000, UNSURE, np.uint8)
    for code in range(0x30000):
        char = chr(code)
        kind = unicodedata.category(char)
        if old.category(char) == kind and kind not in ("Cn", "Cs", "Co"):
            out[code] = {"L": L, "N": N}.get(kind[0], O)
    out[WHITE] = WS
    for chars, kind in (("'", AP), ("stmd", S1), ("r", R), ("v", V), ("e", E), ("l", LL)):
        out[[ord(c) for c in chars]] = kind
    out[0x20] = SP
    return out


def _spaced(state: int, kind: int) -> tuple[int, int]:
    """Transition of: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"""
    white = state in (IN_SP, IN_WS)
    if kind in (SP, WS):
        after = IN_SP if kind == SP else IN_WS
        late = BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
        return after, late if white else late | HERE
    # the last white character leaves its run: a space joins this word, another stands alone
    marks = (BEFORE | (HERE if state == IN_WS else 0)) if white else 0
    return _word(state, kind, marks, joins=state == IN_SP, digits=True)


def _dense(state: int, kind: int) -> tuple[int, int]:
    """Transition of: 's|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+ (white space dropped)"""
    if kind in (SP, WS):
        late = BEFORE if state in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
        return START, late | HERE
    return _word(state, kind, 0, joins=False, digits=False)


def _word(state: int, kind: int, marks: int, joins: bool, digits: bool) -> tuple[int, int]:
    fresh = state in (START, IN_SP, IN_WS)
    if state in (QUOTE_R, QUOTE_V, QUOTE_L):
        first = next(k for k, s in PENDING.items() if s == state)
        if kind == PAIRS[first]:
            return START, 0
        marks |= BEFORE  # the quote stood alone and a letter run began after it
        state = IN_L
    if state == QUOTE and kind == S1:
        return START, 0
    if state == QUOTE and kind in PENDING:
        return PENDING[kind], 0
    if kind in LETTERS:
        return IN_L, marks | (0 if state == IN_L or joins else HERE)
    if kind == N:
        return (IN_N if digits else START), marks | (0 if state == IN_N or joins else HERE)
    if kind == AP and not joins and state not in (IN_O, QUOTE):
        return QUOTE, marks | HERE
    return IN_O, marks | (0 if state in (IN_O, QUOTE) or joins else HERE) if not fresh else marks | (0 if joins else HERE)


class Transducer:
    """Tables of one compiled pattern; classes ``k + 12`` are class k as the first of a text."""

    def __init__(self, step):
        states, kinds = 10, 24
        self.next = np.zeros((states, kinds), np.uint8)
        self.marks = np.zeros((states, kinds), np.uint8)
        for s in range(states):
            for k in range(12):
                self.next[s, k], self.marks[s, k] = step(s, k if k != UNSURE else O)
                to, mark = step(START, k if k != UNSURE else O)
                late = BEFORE if s in (QUOTE_R, QUOTE_V, QUOTE_L) else 0
                self.next[s, k + 12], self.marks[s, k + 12] = to, mark | late
        # the monoid of state maps
        maps = {tuple(range(states)): 0}
        todo, then = [tuple(range(states))], {}
        for m in todo:
            for k in range(kinds):
                new = tuple(int(self.next[s, k]) for s in m)
                if new not in maps:
                    maps[new] = len(maps)
                    todo.append(new)
                then[maps[m], k] = maps[new]
        table = np.array(sorted(maps, key=maps.get), np.uint8)
        n = len(table)
        self.map_of = table
        self.extend = np.array([[then[m, k] for k in range(kinds)] for m in range(n)], np.uint16)
        self.compose = np.array([[maps[tuple(int(table[b][s]) for s in table[a])] for b in range(n)] for a in range(n)], np.uint16)

    def run(self, kinds: np.ndarray) -> np.ndarray:
        """Whether a word starts at each character of ``kinds`` (classes, texts joined)."""
        n = len(kinds)
        rows = -(-n // CHUNK)
        grid = np.zeros(rows * CHUNK, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        maps = np.zeros(rows, np.uint16)
        for column in grid:
            maps = self.extend[maps, column]
        reach = 1
        while reach < rows:  # maps[i] becomes the map of all chunks up to i
            maps[reach:] = self.compose[maps[:-reach], maps[reach:]]
            reach *= 2
        state = np.zeros(rows, np.uint8)
        state[1:] = self.map_of[maps[:-1], START]
        marks = np.empty((CHUNK, rows), np.uint8)
        for i, column in enumerate(grid):
            marks[i] = self.marks[state, column]
            state = self.next[state, column]
        # a quote that waits at the very end
        marks = marks.T.reshape(-1)[:n]
        starts = (marks & HERE).astype(bool)
        starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
        return starts


_CODE = mix(np.arange(0x110000, dtype=np.uint64), 7)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP, _DOWN = _powers(_BASE, PIECE * 2), _powers(pow(_BASE, -1, 2**64), PIECE * 2)


class WordTokens:
    """Token ids of words, remembered by hash; unknown words go to the library once."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        # byte-level vocabularies write byte b as one printable character
        from tokenizers.pre_tokenizers import ByteLevel

        shown = [b for b in range(256) if b in range(33, 127) or b in range(161, 173) or b in range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte_chars = dict(zip(shown, shown)) | {b: 256 + i for i, b in enumerate(hidden)}
        assert {chr(c) for c in self.byte_chars.values()} == set(ByteLevel.alphabet())
        self.clear()

    def clear(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def look_up(self, hashes: np.ndarray, word_at) -> np.ndarray:
        """The slot of each hash; ``word_at(i)`` is the i-th word's string."""
        if len(self.hashes) > TABLE_MOST:
            self.clear()
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == keys[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            model, bytes_as_chars = self.tokenizer.model, self.byte_chars
            found = [[t.id for t in model.tokenize(word_at(i).encode().decode("latin-1").translate(bytes_as_chars))]
                     for i in first[new].tolist()]
            slots = np.arange(len(new)) + len(self.starts) - 1
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in found])])
            self.ids = np.concatenate([self.ids, np.fromiter(
                (i for x in found for i in x), np.int32, int(self.starts[-1]) - len(self.ids))])
            self.hashes = np.insert(self.hashes, at[new], keys[new])
            self.slots = np.insert(self.slots, at[new], slots)
            at = np.searchsorted(self.hashes, keys)
        return self.slots[at][back]


class Encoder:
    """Token counts and ids of whole texts, equal to the library's."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dense = pattern == "dense"
        self.transducer = Transducer(_dense if self.dense else _spaced)
        self.classes = char_classes()
        self.words = WordTokens(self.tokenizer)

    def _normal(self, text: str) -> str:
        if not self.dense:
            return text
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _parts(self, text: str):
        """Runs of about PIECE characters, cut where white space begins."""
        while len(text) > PIECE:
            cut = next((i for i in range(PIECE, len(text)) if text[i].isspace() and not text[i - 1].isspace()
                        and self.classes[ord(text[i])] in (SP, WS) and self.classes[ord(text[i - 1])] not in (SP, WS)), None)
            if cut is None:
                break
            yield text[:cut]
            text = text[cut:]
        yield text

    def _runs(self, texts: list[str]):
        """(text number, normal string) of parts the transducer takes, in runs; (number, None) for the library."""
        run, size = [], 0
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                yield [(i, None)]
                continue
            for part in self._parts(self._normal(text)):
                run.append((i, part))
                size += len(part)
                if size >= PIECE:
                    yield run
                    run, size = [], 0
        if run:
            yield run

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order of text, number of ids of each text)."""
        ids, owners = [], []
        pending = {}
        for run in self._runs(texts):
            if run[0][1] is None:
                pending[run[0][0]] = None
                continue
            found, owner, unsure = self._run(run)
            pending.update(dict.fromkeys(unsure))
            ids.append(found)
            owners.append(owner)
        all_ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        if pending:
            keep = ~np.isin(owner, list(pending))
            exact = [np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.int32) for i in pending]
            all_ids = np.concatenate([all_ids[keep], *exact])
            owner = np.concatenate([owner[keep], *[np.full(len(x), i) for i, x in zip(pending, exact, strict=True)]])
            order = np.argsort(owner, kind="stable")
            all_ids, owner = all_ids[order], owner[order]
        return all_ids, np.bincount(owner, minlength=len(texts))[:len(texts)]

    def _run(self, run: list[tuple[int, str]]):
        joined = "".join(part for _, part in run)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        n = len(codes)
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), []
        lengths = np.array([len(part) for _, part in run])
        begins = (np.cumsum(lengths) - lengths)[lengths > 0]
        numbers = np.array([i for i, _ in run])[lengths > 0]
        kinds = self.classes[codes]
        unsure = []
        if (kinds == UNSURE).any():
            unsure = np.unique(numbers[np.searchsorted(begins, np.flatnonzero(kinds == UNSURE), "right") - 1]).tolist()
        marked = kinds.copy()
        marked[begins] += 12
        # one more symbol closes a quote that waits at the end
        first = np.flatnonzero(self.transducer.run(np.append(marked, np.uint8(SP + 12)))[:n])
        past = np.append(first[1:], n)
        if self.dense:
            word = (kinds[first] != SP) & (kinds[first] != WS)
            first, past = first[word], past[word]
        up, down = (_UP, _DOWN) if n <= PIECE * 2 else (_powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODE[codes] * up[:n], out=total[1:])
        hashes = mix((total[past] - total[first]) * down[first] + (past - first).astype(np.uint64))
        slots = self.words.look_up(hashes, lambda i: joined[first[i]:past[i]])
        sizes = self.words.starts[slots + 1] - self.words.starts[slots]
        ends = np.cumsum(sizes)
        at = np.repeat(self.words.starts[slots] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        owner = np.repeat(numbers[np.searchsorted(begins, first, "right") - 1], sizes)
        return self.words.ids[at], owner, unsure


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of a vocabulary file; pattern ``spaced`` or ``dense``."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def texts_of(array: pa.Array) -> list[str]:
    return [sys.intern("") if x is None else x for x in array.to_pylist()]
