"""The ten training-data operators against brute force, with nulls, empty and long
texts, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradeflow.llm import graph, jaccard_join, packing, quality_rules, textscan, transducer, url_filter
from tradeflow.llm.chat_format import format_chats, read_chats
from tradeflow.llm.common import noting
from tradeflow.llm.graph import components
from tradeflow.llm.jaccard_join import jaccard_components
from tradeflow.llm.license_scan import scan_licenses
from tradeflow.llm.mixing import mix, mix_documents
from tradeflow.llm.nn_descent import near_duplicates
from tradeflow.llm.packing import Capacity, pack, plan_packing
from tradeflow.llm.pu_classifier import keep_quality, score_quality
from tradeflow.llm.token_count import count_tokens
from tradeflow.llm.url_filter import filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
EXTRA = "lang string, source string, n_chars long, size long, `key` string, node long, n long, uid long, score double, quality string, at long"


def sentence(rnd: random.Random, n: int) -> str:
    parts = ["the", "of", "and", "ver", "sch", "ción", "Été", "li", "na", "to", "ra", "mi"]
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def sample_texts() -> list[str | None]:
    rnd = random.Random(7)
    base = sentence(rnd, 120)
    words = base.split()
    near = [" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in (5, 60, 110)]
    far = [" ".join(words[:40] + sentence(rnd, 100).split())]
    line = "Released under the MIT License."
    return [
        None, "", " \t\n\x0b\f\r ", "one", "one two three four", "One two three four", "one two three four five",
        base, base, base.upper().lower(), *near, *far, base + "\n" + line, f"{line}\n{line}\nAll rights reserved. CC BY",
        "This work is licensed under the GNU General Public License, version 3.",
        "buy now " * 40, "same line here\n" * 6 + "last", "### $$$ <tag> | & % *", "a b c d e f g h a b c d e f g h tail",
        sentence(rnd, 3000), "x" * 5000, "naïve café 'tis don't we'll <|endoftext|> ٣ ½ 中文 😀", sentence(rnd, 30), sentence(rnd, 25),
    ]


def documents(spark, texts=None):
    texts = sample_texts() if texts is None else texts
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 1, 5, "k", 9, 9, 9, 0.5, "q", 3) for i, t in enumerate(texts)]
    if len(rows) > 10:
        rows += [rows[8], (None, *rows[10][1:])]  # a repeated row, a row without an id
    return spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")


def by_id(df, *cols):
    return sorted((tuple(r[c] for c in ("doc_id", *cols)) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


def repeated_words(words: list[str]) -> int:
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    return len({p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 8)})


def test_quality_rules(spark):
    docs = documents(spark)
    out = quality_rules.quality_rules(docs, name="verdict")
    assert out.columns == [*docs.columns, "verdict"]
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
    for row in out.collect():
        text, got = row["text"] or "", row["verdict"]
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        assert got["n_words"] == len(words)
        assert got["word_chars"] == len("".join(words))
        assert got["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert got["n_dup_lines"] == len(lines) - len(set(lines))
        assert got["n_repeat_words"] == repeated_words(words), text[:60]
        assert got["base_failed"] == (len(words) < 20 or 100 * got["n_repeat_words"] > 30 * len(words))
        assert got["kept"] == (not got["base_failed"] and not got["failed_rules"])
    assert quality_rules.quality_rules(documents(spark, [])).count() == 0


def test_chat_format_round_trip(spark):
    rnd = random.Random(3)
    bits = ["<|", "|>", "<\\|", "<\\\\|im_end|>", "<|im_start|>assistant", "<|endoftext|>", "ok", " é\n", "<", "|", "\\", "'ll"]
    rows = [(c, t, rnd.choice(["user", "assistant", None, "a<|b"]), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8))), 1)
            for c in range(40) for t in range(rnd.randint(1, 5))]
    rows += [(99, None, "assistant", None, 1), (None, 0, "user", "x", 1), (99, 1, "user", "same", 1), (99, 1, "user", "same", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at long")
    formatted = format_chats(turns, BYTE_BPE)
    said = defaultdict(list)
    for c, t, role, text, _ in rows:
        said[c].append((-1 if t is None else t, role or "", text or ""))
    back = {r["conv_id"]: r for r in read_chats(formatted, BYTE_BPE).collect()}
    assert set(back) == set(said)
    for c, want in said.items():
        want.sort()
        assert [(x["role"], x["text"]) for x in back[c]["turns"]] == [w[1:] for w in want]
        assert back[c]["loss_text"] == "".join(t for _, r, t in want if r == "assistant")
    sizes = {r["conv_id"]: (r["n_turns"], r["formatted_chars"]) for r in formatted.collect()}
    assert sizes == {c: (len(w), back[c]["formatted_chars"]) for c, w in said.items()}
    assert format_chats(turns.limit(0), BYTE_BPE).count() == 0


def expected_pieces(text: str | None, tokenizer, size: int):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    return [(i // size, i, len(ids[i:i + size]), zlib.crc32(np.array(ids[i:i + size], "<u4").tobytes())) for i in range(0, len(ids), size)]


def test_packing(spark):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    docs = documents(spark)
    for capacity in (Capacity(), Capacity(tokens=512), Capacity(tokens=512, documents=3, attention=150_000),
                     Capacity(tokens=512, rule="dot", documents=4)):
        if capacity.attention:
            capacity = Capacity(**{**capacity.__dict__, "attention": 512 * 512})
        got = pack(docs, WORD_BPE, capacity=capacity).collect()
        want = Counter((r["doc_id"], *p) for r in docs.collect() for p in expected_pieces(r["text"], tokenizer, capacity.tokens))
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        sequences = defaultdict(list)
        for r in got:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity.tokens and len(parts) <= (capacity.documents or at)
            assert sum(n * n for _, n in parts) <= (capacity.attention or at * at)
    assert pack(documents(spark, []), WORD_BPE).count() == 0


def test_packing_where_attention_binds(spark):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    docs = documents(spark)
    capacity = Capacity(tokens=512, documents=3, attention=150_000)
    got = pack(docs, WORD_BPE, capacity=capacity).collect()
    want = Counter((r["doc_id"], *p) for r in docs.collect() for p in expected_pieces(r["text"], tokenizer, 387))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    cost = Counter()
    for r in got:
        cost[r["sequence_id"]] += r["length"] ** 2
    assert max(cost.values()) <= 150_000


@pytest.mark.parametrize("capacity", [Capacity(tokens=64), Capacity(tokens=64, documents=3), Capacity(tokens=64, documents=5, attention=2500, rule="norm"),
                                      Capacity(tokens=64, documents=4, rule="dot")])
def test_runs_equal_piece_by_piece_best_fit(capacity):
    rnd = random.Random(5)
    for _ in range(20):
        lengths = Counter(rnd.randint(1, 50) for _ in range(rnd.randint(1, 120)))
        full = capacity.vector()
        scale = np.array(capacity.weights) / (full**2 if capacity.rule == "norm" else full)
        open_: list[np.ndarray] = []
        for length in sorted(lengths.elements(), reverse=True):
            need = np.array([length, 1, length * length])
            fits = [i for i, r in enumerate(open_) if (r >= need).all() and (r > 0).all()]
            if not fits:
                open_.append(full - need)
                continue
            score = [(((open_[i] - need) ** 2) * scale).sum() if capacity.rule == "norm"
                     else -((open_[i] / full) * need * scale).sum() for i in fits]
            best = fits[min(range(len(fits)), key=lambda j: (round(score[j], 12), j))]
            open_[best] = open_[best] - need
        runs = plan_packing(dict(lengths), capacity)
        assert sum(r[2] for r in runs) == sum(lengths.values())
        used = len({r[3] + i // r[5] for r in runs for i in range(r[2])})
        assert abs(used - len(open_)) <= (0 if capacity.rule == "norm" else 1)


def jaccard_truth(rows):
    sets = []
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOW))
        sets.append((i, {tuple(words[j:j + 5]) for j in range(max(len(words) - 4, 1))} if words else set()))
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    out = []
    for (i, s), l in zip(sets, label, strict=True):
        group = [sets[k][0] for k in range(len(sets)) if label[k] == l and sets[k][0] is not None]
        out.append((i, len(s), min(group, default=None) if s else i))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


def test_jaccard_join(spark):
    rnd = random.Random(11)
    texts = sample_texts()
    passage = sentence(rnd, 60)
    for _ in range(12):  # unlike texts round one long passage
        texts.append(sentence(rnd, rnd.randint(3, 40)) + " " + passage + " " + sentence(rnd, rnd.randint(3, 40)))
    seed = sentence(rnd, 80).split()
    for _ in range(30):  # a crowd of near copies, some within and some beyond the radius of each other
        words = list(seed)
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(["alpha", "beta", "gamma"])
        texts.append(" ".join(words))
    docs = documents(spark, texts)
    want = jaccard_truth([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert by_id(jaccard_components(docs, block=8), "n_shingles", "component_id") == want
    assert jaccard_components(documents(spark, [])).count() == 0
    assert by_id(jaccard_components(documents(spark, [None, ""])), "n_shingles", "component_id")


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if k in got} and set(label) - set(got) <= {a for a, b in edges if a == b}


def test_components_of_stars_take_no_round(spark):
    edges = spark.createDataFrame([(1, 5), (9, 1), (2, 3), (2, 3), (3, 2), (4, 4)], "a long, b long")
    with noting(left := []):
        assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 2), (3, 2), (5, 1), (9, 1)]
    assert len(left) == 1
    # two centres that share a leaf, and a chain, are no stars
    for more in ([(1, 9), (2, 9)], [(1, 2), (2, 3)]):
        got = components(spark.createDataFrame(more, "a long, b long")).collect()
        assert {r["component"] for r in got} == {1} and len(got) == 3


def test_jaccard_join_lets_go_of_shuffles(spark, monkeypatch):
    """After each large step, what it shuffled is let go before the next one begins."""
    calls = []

    def watched(df, name, put=jaccard_join.stage):
        calls.append(name)
        return put(df, name)

    monkeypatch.setattr(jaccard_join, "stage", watched)
    for module in (jaccard_join, graph):
        monkeypatch.setattr(module, "free_shuffles", lambda session: calls.append("free"), raising=False)
    jaccard_components(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e F")], "doc_id long, text string"))
    for name in ("candidates", "sets", "kept", "regions", "measured", "links"):
        assert calls[calls.index(name) + 1] == "free", (name, calls)


def test_token_counts(spark):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    docs = documents(spark)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), n := len(tokenizer.encode(r["text"] or "").ids), n > 512)
                   for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))
    assert by_id(count_tokens(docs, BYTE_BPE), "n_bytes", "n_tokens", "over_limit") == want
    assert count_tokens(documents(spark, []), BYTE_BPE).count() == 0


@pytest.mark.parametrize("path, pattern", [(BYTE_BPE, "spaced"), (WORD_BPE, "dense")])
def test_transducer_equals_library(path, pattern, monkeypatch):
    rnd = random.Random(1)
    alphabet = list("abstmdrvel'’ \n\t.,!-190ABSTMDéßñÉİΣσ") + ["'s", "'re", "'ll", "n't", "  ", " \"", "\u2003", "\u0301", "中", "😀",
                                                                 "\x85", "\x1c", "\u200b", "Ⅷ", "½", "<|endoftext|>", "\u180e", "ﬁ"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rnd.choice("abstmdrvel' \n.1") for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    texts += ["word " * 900 + "x" * 3000 + " end"]
    encoder = transducer.Encoder(path, pattern)
    monkeypatch.setattr(transducer, "PIECE", 700)
    ids, counts = encoder.encode(texts)
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_word_scan(monkeypatch):
    import pyarrow as pa

    texts = [*sample_texts(), "wörd ñ " * 3000, "y" * 9000 + " z"]
    monkeypatch.setattr(textscan, "PIECE", 512)
    for pattern, member in ((WORD, textscan.SPACED), (NAMED, textscan.ALNUM)):
        want = [pattern.findall((t or "").translate(LOW)) for t in texts]
        hashes, counts = textscan.words(pa.array(texts), member, textscan.LOWER)
        assert counts.tolist() == [len(w) for w in want]
        names = dict(zip((w for x in want for w in x), hashes.tolist(), strict=True))
        assert len(set(names.values())) == len(names)
        assert [names[w] for x in want for w in x] == hashes.tolist()


def test_url_filter(spark):
    entries = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
               ("block", "com", "/de/"), ("block", "Bad.example.com", ""), ("allow", "bad.example.com", "/ok")]
    rnd = random.Random(4)
    hosts = ["org", "example.org", "a.Example.ORG", "com", "x.com", "bad.example.com", "q.bad.example.com", "net", "", "notexample.org", "b.org:80"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/10/x", "/en/2", "/fr/", "/de/x/y", "/ok", "/okay?x=/es/", "/a#/es/", "?q=/de/"]
    urls = [f"{rnd.choice(['http', 'HTTPS'])}://{h}{p}" for h in hosts for p in paths] + [None, "", "nothing", "a://b://c/d", "http://x.com\n/de/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(0, urls[0], 1)], "page_id long, url string, host long")
    out = filter_urls(pages, entries).collect()
    assert len(out) == len(urls) + 1
    for r in out:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r["page_id"]] or "")
        host, path = (m[1].translate(LOW), m[2]) if m else ("", "")
        fits = [(len(h.split(".")), len(p), v, h.lower() + p) for v, h, p in entries
                if host and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        best = max(fits, default=None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best[3], best[2] if best else "allow")
    with pytest.raises(ValueError):
        url_filter.build_trie([("allow", "a", "/"), ("block", "A", "/")])
    assert filter_urls(pages.limit(0), entries).count() == 0


def test_quality_classifier(spark):
    rnd = random.Random(9)
    good = [sentence(rnd, rnd.randint(30, 90)) + "." for _ in range(300)]
    bad = ["$$$ ".join(sentence(rnd, 40).split()) for _ in range(40)] + ["Der " * 60 for _ in range(20)]
    texts = [None, "", "short", *good, *bad]
    docs = documents(spark, texts)
    truth = {i: int(3 <= i < 303) for i in range(3, len(texts))}
    labels = spark.createDataFrame([(i, q if i % 2 else None, 0) for i, q in truth.items()] + [(5, 1, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = score_quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)
    right = [r["predicted"] == truth[r["doc_id"]] for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(right) > 30 and np.mean(right) > 0.97
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in out)
    assert score_quality(documents(spark, []), labels).count() == 0
    assert {r["predicted"] for r in score_quality(docs, labels.limit(0)).collect()} == {1}


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    x = [c + s * rng.standard_normal(16) for c in centres for s in (0.05, 0.1, 0.3) for _ in range(25)]
    x += list(rng.standard_normal((150, 16))) + [x[0], x[0], 2.5 * x[7], np.zeros(16), np.full(16, 1e200), np.full(16, 1e-200)]
    rows = [(i, [float(v) for v in e], 0) for i, e in enumerate(x)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [float("nan")] + [1.0] * 15, 0), (n + 3, [None] + [1.0] * 15, 0), (n + 4, [1.0, 2.0], 0), (n + 5, [1.0, 2.0], 0)]
    out, audit = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r["vec_id"]: r for r in out.collect()}
    unit = np.array([e / np.abs(e).max() / np.linalg.norm(e / np.abs(e).max()) if np.abs(e).max() else np.zeros(16) for e in x])
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    assert len(got) == len(rows) and audit["recall"] >= 0.98
    found = np.array([got[i]["n_links"] for i in range(n)])
    assert (found <= linked.sum(1)).all() and found.sum() >= 0.98 * linked.sum()
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in [n - 3, n, n + 1, n + 2, n + 3])
    assert [got[n + k]["component_id"] for k in (4, 5)] == [n + 4] * 2
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    empty, _ = near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert empty.count() == 0


def brute_links(x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Links of each vector, and the smallest member of its component."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            return linked.sum(1), label.tolist()
        label = new


def embeddings(spark, x: np.ndarray):
    return spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec_id long, embedding array<double>")


def test_embedding_dedup_joins_tight_subgroups(spark):
    rng = np.random.default_rng(4)
    x = []
    for _ in range(10):  # two crowds of 20, centres at cosine 0.94: the 10 nearest are all in the own crowd
        a, b = np.linalg.qr(rng.standard_normal((48, 2)))[0].T
        for centre in (a, 0.94 * a + np.sqrt(1 - 0.94**2) * b):
            x += [centre + 0.005 * rng.standard_normal(48) for _ in range(20)]
    links, component = brute_links(np.array(x))
    assert links.min() == 39
    got = {r["vec_id"]: r for r in near_duplicates(embeddings(spark, np.array(x)))[0].collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == links.tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == component


def test_embedding_dedup_finds_pairs_beside_a_crowd(spark):
    rng = np.random.default_rng(5)
    centre, apart = rng.standard_normal(32), rng.standard_normal((400, 32))
    x = [centre + 0.01 * rng.standard_normal(32) for _ in range(600)]
    for v in apart:  # pairs near the threshold
        v /= np.linalg.norm(v)
        side = rng.standard_normal(32)
        side -= (side @ v) * v
        x += [v, 0.905 * v + np.sqrt(1 - 0.905**2) * side / np.linalg.norm(side)]
    links, component = brute_links(np.array(x))
    out, audit = near_duplicates(embeddings(spark, np.array(x)))
    got = {r["vec_id"]: r for r in out.collect()}
    pairs = range(600, len(x))
    assert sum(got[i]["n_links"] == links[i] for i in pairs) >= 0.98 * len(pairs)
    assert audit["recall"] == pytest.approx(min(np.mean([min(got[i]["n_links"], links[i]) / links[i] for i in ids if links[i]])
                                                for ids in (range(600), pairs)))
    assert [got[i]["n_links"] for i in range(600)] == links[:600].tolist()


def test_embedding_audit_that_cannot_tell_compares_all(spark, monkeypatch):
    from tradeflow.llm import nn_descent

    monkeypatch.setattr(nn_descent, "QUERIES", 16)
    monkeypatch.setattr(nn_descent, "MOST_QUERIES", 32)
    monkeypatch.setattr(nn_descent, "EXACT_BLOCK", 64)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 24))
    x[200:210] = x[:10] + 0.3 * rng.standard_normal((10, 24))
    links, component = brute_links(x)
    out, audit = near_duplicates(embeddings(spark, x))
    got = {r["vec_id"]: r for r in out.collect()}
    assert audit["exact"] and links.sum() >= 10
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(len(x))] == list(zip(links.tolist(), component, strict=True))


def test_embedding_lists_settle(spark, monkeypatch):
    from tradeflow.llm import nn_descent

    for n in (1, 1000, 50_000, 10_000_000):
        bits, tables = nn_descent.block_plan(n, 0.9)
        assert n / 2**bits <= nn_descent.WISHED and 1 - (1 - (1 - np.arccos(0.9) / np.pi)**bits)**tables >= nn_descent.MEET
    monkeypatch.setattr(nn_descent, "WISHED", 1)
    monkeypatch.setattr(nn_descent, "MEET", 0.1)
    x = np.random.default_rng(7).standard_normal((200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pool = spark.createDataFrame([(i, e.tolist(), 1) for i, e in enumerate(x)], "node long, vec array<double>, copies long")
    monkeypatch.setattr(nn_descent, "FULL", 40)
    found = nn_descent._merge(nn_descent.first_lists(pool, 10, 0.9, 1, seed=0), 10).localCheckpoint()
    assert found.count() == 200  # also nodes that are alone in their hyperplane blocks
    lists, changed = nn_descent.settle(pool, found, 10)
    assert len(changed) > 1 and changed[-1] <= nn_descent.CHANGED < changed[0]
    sims = x @ x.T
    np.fill_diagonal(sims, -9)
    best = np.argsort(-sims, axis=1)[:, :10]
    assert sum(len({e["node"] for e in r["list"]} & set(best[r["node"]].tolist())) for r in lists.collect()) >= 0.9 * 2000


def test_license_scan(spark):
    notice = "This program is free software: you can redistribute it and/or modify it kindly under the terms of the GNU General Public License as published"
    docs = documents(spark, [
        *sample_texts(), "cc by cc by general public license", "pad " * 50 + notice, "general public", "CC-BY", "all rights all rights reserved"])
    phrases = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    out = scan_licenses(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        if r["doc_id"] is None:
            continue
        words = NAMED.findall((rows[r["doc_id"]] or "").translate(LOW))
        places = [(i, name) for name, p in phrases.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r["base_labels"] == ",".join(sorted({name for _, name in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    found = {r["doc_id"]: r["labels"] for r in out}
    assert "gpl-3.0" in found[len(sample_texts()) + 1] and "mit" in found[15]
    assert scan_licenses(documents(spark, [])).count() == 0


def test_license_labels_need_different_places(spark):
    """A word pair that recurs holds one place of a template, however often it votes."""
    notice = dict.fromkeys(("free software " * 14, "free software is " * 10, "license version " * 30), "")
    notice["licensed under the gnu general public license version 3"] = "gpl,gpl-3.0"
    notice["free software " * 14 + "pad " * 200 + "released under the mit license"] = "mit"
    docs = spark.createDataFrame(list(enumerate(notice)), "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in scan_licenses(docs).collect()} == dict(enumerate(notice.values()))


def test_mixing_keeps_columns_of_its_own_names(spark):
    rows = [(i, f"some words here {i}", f"s{i % 2}", 1000 + i, str(i), None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `__row` long, `__copies` string, `__HASH` int")
    out = mix_documents(docs).collect()
    assert out and {tuple(r) for r in out} <= set(rows)


def targets_by_rounds(sizes: list[int]) -> list[float]:
    """Share by weight, cap at three times the size, share the excess again."""
    weight = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    capped: set[int] = set()
    while True:
        rest = sum(sizes) - sum(3 * sizes[i] for i in capped)
        others = sum(w for i, w in enumerate(weight) if i not in capped)
        now = [3.0 * s if i in capped else w * rest / others for i, (s, w) in enumerate(zip(sizes, weight, strict=True))]
        over = {i for i, t in enumerate(now) if i not in capped and t > 3 * sizes[i]}
        if not over:
            return now
        capped |= over


def test_mixing(spark):
    rnd = random.Random(8)
    rows = [(i, sentence(rnd, rnd.randint(0, 30)), rnd.choice(["b", "a", None, "ä", "Z", "tiny", "none"]) if i % 3 else "big") for i in range(400)]
    rows = [(i, t if s != "none" else " ", s) for i, t, s in rows if s != "tiny"] + [(900, "few words", "tiny"), (901, None, "a"), (3, rows[3][1], rows[3][2]), (None, "no id", "b")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size long, `key` string")
    got = mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, mix(docs.repartition(5)).collect()))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = dict(zip(names, targets_by_rounds([sizes[s] for s in names]), strict=True))
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert len(got) == len(rows)
    assert all(taken[s] == int(target[s] + 1e-9) for s in names)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert all(abs(words[s] - target[s]) <= 30 for s in names)
    assert mix(docs.limit(0)).count() == 0 and mix_documents(docs.limit(0)).count() == 0


def test_mixing_rows_without_an_id_keep_their_source(spark):
    rows = [(None, "one two three four five " * 4, source) for source, n in (("a", 90), ("b", 10)) for _ in range(n)]
    words = Counter()
    for r in mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        words[r["source"]] += len(r["text"].split())
    assert words["b"] == 600 and abs(words["a"] - 1400) <= 20


def test_hash_of_turns_contract(spark, tmp_path):
    from tradeflow.llm.queries import CONTROL_TEXT, op2_chat_format

    spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in op2_chat_format(spark, str(tmp_path)).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\nyo\n").hexdigest()
    assert got[-1]["loss_sha256"] == hashlib.sha256(CONTROL_TEXT.encode()).hexdigest()
    assert packing.MAX_TOKENS == 4096
