"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

from __future__ import annotations

import os
import random
from collections import Counter

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tradeflow.llm import common
from tests.llm.test_operators import WORD, WORD_BPE, expected_pieces, jaccard_truth, repeated_words, sentence


def small_corpus(spark, folder) -> None:
    rnd = random.Random(21)
    texts = [sentence(rnd, rnd.randint(40, 120)) + " of the and to the end." for _ in range(150)]
    texts += [t.replace(" the ", " THE ", 1) + " end" for t in texts[:20]] + texts[20:30]  # near and exact copies
    texts += ["$$$ ".join(sentence(rnd, 40).split()) for _ in range(60)] + ["too short"] * 3 + [None, ""]
    rows = [(i, t, "en", f"s{i % 4}", len(t or ""), "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string, lang string, source string, n_chars long, `__copy` string")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 180), 0) for i in range(len(texts)) if i % 3 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages(spark, tmp_path):
    small_corpus(spark, tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "mixing", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    ids = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}
    assert len(ids["quality_classifier"] & set(range(180))) >= 178 and len(ids["quality_classifier"] & set(range(180, 240))) <= 12
    for r in kept["quality_classifier"]:
        words = WORD.findall(r["text"] or "")
        fails = len(words) < 20 or 100 * repeated_words(words) > 30 * len(words)
        assert not (fails and r["doc_id"] in ids["quality_rules"])
    assert ids["quality_rules"] >= ids["quality_classifier"] & set(range(180)) and not ids["quality_rules"] & set(range(180, 240))
    groups = jaccard_truth([(r["doc_id"], r["text"]) for r in kept["quality_rules"]])
    assert sorted(r["doc_id"] for r in kept["near_duplicates"]) == sorted({component for _, _, component in groups})
    taken, size = Counter(), Counter()
    for name, count in (("near_duplicates", size), ("mixing", taken)):
        for r in kept[name]:
            count[r["source"]] += len(WORD.findall(r["text"]))
    assert max(Counter(r["doc_id"] for r in kept["mixing"]).values()) <= 3
    weight = {s: w for s, w in zip(sorted(size), (1, 2, 3, 1))}
    assert all(abs(taken[s] - min(3 * size[s], sum(size.values()) * weight[s] / 7)) <= 200 for s in size)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = Counter((r["doc_id"], *p) for r in kept["mixing"] for p in expected_pieces(r["text"], tokenizer, 4096))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in kept["packing"]) == want
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in whole) == Counter((r["doc_id"], r["ids_crc32"]) for r in kept["packing"])


def test_empty_documents(spark, tmp_path):
    small_corpus(spark, tmp_path / "full")
    spark.read.parquet(f"{tmp_path}/full/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/full/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_without_an_id(spark, tmp_path):
    rnd = random.Random(4)
    texts = [sentence(rnd, 80) for _ in range(4)]
    rows = [(None, texts[0], "a"), (None, texts[0] + " end", "a"), (7, texts[1] + " end", "a"), (None, texts[1], "a"),
            (8, texts[2], "a"), (8, texts[3], "a"), (9, texts[3] + " end", "a"), (None, None, "a"), (None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert len(kept) == 5 and {(7, texts[1] + " end"), (8, texts[2]), (8, texts[3]), (None, None)} <= set(kept)
    assert sum(i is None and t is not None for i, t in kept) == 1


def test_near_duplicates_keep_columns_of_their_own_names(spark, tmp_path):
    rnd = random.Random(6)
    text = sentence(rnd, 80)
    rows = [(1, text, 5, "a"), (2, text + " end", 6, "b"), (3, "", 7, "c"), (3, "", 7, "c"), (4, " ", 8, "d"), (None, None, 9, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__row` long, `__Hash` string")
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)


def test_rows_are_selected_also_where_bitmaps_cannot_tell(spark, monkeypatch):
    monkeypatch.setattr(common, "bitmap_bits", lambda n, each=16: 15)
    rows = spark.range(60_000).select("id", (F.col("id") * 2).alias("x"))
    kept, others = rows.filter("id % 3 = 0").select("id"), rows.filter("id % 3 != 0").select("id")
    out = common.select_rows(rows, "id", kept, others)
    assert out.columns == ["id", "x"] and out.count() == 20_000 and out.filter("id % 3 != 0 OR x != 2 * id").count() == 0


def test_what_stages_leave_is_removed_once_their_result_is_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"w{i} some words", "s") for i in range(30)], "doc_id long, text string, source string")
    corpus_pipeline.LEFT.clear()
    mixed = corpus_pipeline.mixing(spark, docs, str(tmp_path))
    left = list(corpus_pipeline.LEFT)
    assert left and all(os.path.exists(f.removeprefix("file:")) for f in left)
    common.release(corpus_pipeline.LEFT, mixed)  # still to be computed from them
    assert corpus_pipeline.LEFT == left and mixed.count() > 0
    mixed.write.parquet(f"{tmp_path}/mixed")
    common.release(corpus_pipeline.LEFT, spark.read.parquet(f"{tmp_path}/mixed"))
    assert not corpus_pipeline.LEFT and not any(os.path.exists(f.removeprefix("file:")) for f in left)


def test_near_duplicates_copy_no_texts(spark, tmp_path):
    small_corpus(spark, tmp_path)
    corpus_pipeline.LEFT.clear()
    corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    staged = [spark.read.parquet(f).columns for f in corpus_pipeline.LEFT if os.path.exists(f.removeprefix("file:"))]
    assert staged and not any("text" in columns for columns in staged)


def test_rows_are_numbered_alike_in_every_scan(spark, tmp_path):
    rows = spark.range(1_000, numPartitions=3).selectExpr("id", "cast(id % 7 AS string) AS text", "'a b%c' AS `__file`")
    rows.write.partitionBy("text").parquet(f"{tmp_path}/a b%c")
    for docs in (spark.read.parquet(f"{tmp_path}/a b%c"), rows, rows.limit(0), spark.read.parquet(f"{tmp_path}/a b%c").filter("id > 9")):
        out = common.numbered(docs, "n")
        want = docs.count()
        assert out.columns == [*docs.columns, "n"] and out.select("n").distinct().count() == out.count() == want
        assert sorted(map(tuple, out.select("n", "id").collect())) == sorted((r["n"], r["id"]) for r in out.collect())
