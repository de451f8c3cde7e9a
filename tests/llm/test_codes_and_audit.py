"""Byte-pair codec, vector codes and the source audit against brute force and their SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF0001
from tests.llm.test_operators import BYTE_BPE, WORD_BPE, documents, sample_texts
from tradeflow.llm import bpe, divergence, vector_codes
from tradeflow.llm.oracle import SQL
from tradeflow.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def odd_texts() -> list[str]:
    rnd = random.Random(5)
    letters = "abeinorst AB  \n\t'’éüßİΣσςÅ中文字한국어😀0123456789.,!?-_<|>½٣ͅẞႠ‍\U0001f9ff\U0001fae8"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 160))) for _ in range(400)]
    texts += ["".join(rnd.choice("aeinorst") for _ in range(n)) for n in (63, 64, 65, 127, 900)]
    return texts + ["lol" * 700, "a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "'s 't're've'll'd 'm", " \n "]


@pytest.mark.parametrize(("path", "pattern"), [(WORD_BPE, "dense"), (BYTE_BPE, "spaced")])
def test_codec_equals_the_library(path, pattern):
    texts = [t or "" for t in sample_texts()] + odd_texts()
    library, own = Tokenizer.from_file(path), bpe.codec(path, pattern)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = own.ids_of(texts)
    assert [x.tolist() for x in got] == want
    assert [own.text_of(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]
    rnd = random.Random(2)
    loose = np.array([rnd.randrange(49_000) for _ in range(500)] + [10**6])
    assert own.text_of(loose) == library.decode(loose.tolist(), skip_special_tokens=False)


def merged_plainly(symbols: list[int], pairs: dict) -> list[int]:
    while True:
        ranks = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
        if not ranks:
            return symbols
        _, i = min(ranks)
        symbols = [*symbols[:i], pairs[symbols[i], symbols[i + 1]][1], *symbols[i + 2:]]


def test_segment_trees_merge_leftmost_lowest():
    """A vocabulary in which one piece comes from two pairs, so that the order of merges shows."""
    merges = bpe.Merges.__new__(bpe.Merges)
    rnd = random.Random(9)
    merges.pairs = {}
    for rank in range(40):
        a, b = rnd.randrange(12), rnd.randrange(12)
        merges.pairs.setdefault((a, b), (rank, rnd.randrange(12)))
    keys = np.array([a << bpe.PLACE | b for a, b in merges.pairs], np.int64)
    order = np.argsort(keys)
    merges.keys = np.append(keys[order], bpe.NEVER)
    merges.ranks = np.append(np.array([r for r, _ in merges.pairs.values()], np.int64)[order], 0)
    merges.result = np.zeros(40, np.int32)
    for rank, to in merges.pairs.values():
        merges.result[rank] = to
    for width in (1, 2, 8, 64):
        words = [[rnd.randrange(12) for _ in range(rnd.randint(1, width))] for _ in range(200)]
        grid = np.zeros((len(words), width), np.int32)
        for i, w in enumerate(words):
            grid[i, :len(w)] = w
        out, living = bpe.merge_lanes(grid, np.array([len(w) for w in words]), merges)
        want = [merged_plainly(w, merges.pairs) for w in words]
        assert [row[alive].tolist() for row, alive in zip(out, living, strict=True)] == want
        assert [bpe.merge_word(w, merges) for w in words] == want


def test_codec_tables(spark):
    docs = documents(spark)
    encoded = bpe.encode(docs, WORD_BPE)
    out = bpe.decode(encoded, WORD_BPE)
    assert sorted(out.collect(), key=str) == sorted(bpe.encode(docs, WORD_BPE, decoded=True).collect(), key=str)
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(docs.limit(0), WORD_BPE), WORD_BPE).count() == 0
    unknown = spark.createDataFrame([(1, None, None)], "doc_id long, n_tokens long, ids binary")
    assert bpe.decode(unknown, WORD_BPE).first()["decoded"] == ""


def test_codec_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    for r in QUERIES["op11_bpe_codec"](spark, SF0001).collect():
        ids = library.encode(texts.pop(r["doc_id"]), add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not texts


def codes_plainly(rows: list[tuple], parts: int, entries: int, rounds: int, scale: int):
    """(key, codes, error) of the rows and the final codebooks, by plain loops over Python integers."""
    kept = [(k, v) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v in kept), default=0)
    width = max(-(-longest // parts), 1)
    grid = []
    for k, v in kept:
        own = [min(max(math.floor(x * scale), -2**31), 2**31 - 1) for x in v] + [0] * (parts * width - len(v))
        grid.append((k, [tuple(own[p * width:(p + 1) * width]) for p in range(parts)]))
    first = sorted(grid, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[list(v[p]) for _, v in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v in grid:
                members[near(v[p], books[p])[1]].append(v[p])
            for i, own in members.items():
                books[p][i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = []
    for k, v in grid:
        found = [near(v[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((k, [i for _, i in found], error if error < 2**63 else None))
    return out, [x for p in books for e in p for x in e]


def vectors() -> list[tuple]:
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(9, 10))
    rows = [(i, (centres[i % 9] + 0.4 * rnd.normal(size=10)).tolist()) for i in range(240)]
    rows += [(1000 + i, centres[0].tolist()) for i in range(120)]  # a third of all rows are one vector
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, rows[4][1]), (-5, [0.25] * 10)]
    return rows + [(2000, None), (2001, [1.0, None] * 5), (2002, [float("nan")] * 10), (2003, [float("-inf")] * 10), (2004, [0.5, -0.5]), (2005, [])]


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 16, 4), (3, 500, 2), (2, 5, 1)])
def test_vector_codes(spark, parts, entries, rounds):
    rows = vectors()
    frame = spark.createDataFrame([(k, v, "x", 1.5) for k, v in rows], "vec_id long, embedding array<double>, uid string, error double")
    out = vector_codes.compress_vectors(frame, carry=["uid", "error"][:1], parts=parts, entries=entries, rounds=rounds,
                                        owner_parts=16, partition_parts=100)
    want, books = codes_plainly(rows, parts, entries, rounds, 1024)
    got = [(r["vec_id"], r["codes"], r["error"]) for r in out.rows.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert out.codebooks.reshape(-1).tolist() == books
    assert {r["uid"] for r in out.rows.collect()} == {"x"}
    assert out.digest() == hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()


def test_vector_codes_of_large_components(spark):
    rows = [(1, [1e30, 3.0]), (2, [-1e30, 2.0]), (3, [2e6, -2e6]), (4, [1999999.5, 5.0]), (5, [1e4, 7.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = vector_codes.compress_vectors(frame, parts=2, entries=2, rounds=2)
    want, books = codes_plainly(rows, 2, 2, 2, 1024)
    assert sorted((r["vec_id"], r["codes"], r["error"]) for r in out.rows.collect()) == sorted(want)
    assert out.codebooks.reshape(-1).tolist() == books


def test_vector_codes_of_nothing(spark):
    frame = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    for df in (frame, frame.limit(0)):
        out = vector_codes.compress_vectors(df)
        assert out.rows.count() == 0 and out.rows.columns == ["vec_id", "codes", "error"]
        assert out.digest() == hashlib.sha256(b"").hexdigest()


def test_hot_entry_is_spread():
    """All parts in one entry: its owners stay near their size and fill all partitions."""
    n, size = 100_000, 8192
    layout = (32, 256, -(-n // size))
    uid = np.arange(n, dtype=np.int64)
    salts = np.bincount((vector_codes._scramble(uid) % np.uint64(layout[2])).astype(np.int64))
    assert salts.max() < 1.2 * size
    alike = np.zeros(n, np.int32)
    assert len(np.unique(vector_codes.owner_of(layout, alike, alike, uid))) > 8


def same_as_sql(spark, key: str) -> None:
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF0001}/{name}.parquet')")
    found = QUERIES[key](spark, SF0001)
    columns = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[key]})").fetchall()
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(want)


def test_vector_codes_query(spark):
    same_as_sql(spark, "op12_vector_codes")


def test_license_scan_query(spark):
    same_as_sql(spark, "op9_license_scan")


def test_source_divergence_query(spark):
    same_as_sql(spark, "op13_source_divergence")


def audit_plainly(rows: list[tuple], scale: int, least: int, most: int) -> set[tuple]:
    counts, holds, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOW))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(terms)
        holds[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holds[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + scale * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, x, v, i) for i, (x, v) in enumerate(ranked, 1) if part == "pair" or i <= most}
    return out


def audit_rows() -> list[tuple]:
    texts = [t for t in sample_texts() if t is None or len(t) < 6000]
    rnd = random.Random(3)
    rows = [(rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "é", None, ""]), rnd.choice(texts)) for _ in range(150)]
    rows += [("en", "hot", texts[7])] * 80 + [("xx", "only", "one two"), ("yy", "p", None), ("yy", "q", "!!"), ("en", None, "")]
    return rows + [("en", "big", " ".join(rnd.choice(["Über", "the", "AND", "x1y", "naïve"]) for _ in range(400_000)))]


def test_source_divergence(spark):
    rows = audit_rows()
    docs = spark.createDataFrame([(i, *r, "t", 1, 2, 3) for i, r in enumerate(rows)],
                                 "doc_id long, lang string, source string, text string, term string, n long, p long, `count` long")
    names = ("lang", "source", "part", "item", "value", "rank")
    for least, most in ((3, 200), (1, 5)):
        out = divergence.divergence(docs.repartition(5), least_docs=least, most_terms=most)
        got = [tuple(r[c] for c in names) for r in out.collect()]
        want = audit_plainly(rows, divergence.SCALE, least, most)
        assert len(got) == len(set(got)) and set(got) == want
    # where the bitmap has few bits, texts without copies travel too; the counts are the same
    plain = divergence.group_terms(docs).collect()
    assert sorted(divergence.group_terms(docs, bits=15).collect()) == sorted(plain)
    assert divergence.divergence(docs.limit(0)).count() == 0
