"""A training-data pipeline over ``documents``: five stages, each on all rows the one before kept.

1. quality_classifier: texts that the positive-unlabelled classifier rejects go;
2. quality_rules: texts that fail a rule of the threshold table go;
3. near_duplicates: one document (the smallest id) of each group of texts linked
   by a shingle Jaccard similarity of 0.8 or more stays;
4. mixing: sources are cut or repeated, document by document, to their target
   share of words;
5. packing: the mix is tokenized and packed into sequences of 4096 tokens.

All stages but the last return the columns they were given.  Nulls, empty
texts, repeated rows and empty tables are treated as each operator states.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.common import free_name, noting, numbered, release, select_rows, stage, table, text_or_empty
from tradeflow.llm.jaccard_join import jaccard_components
from tradeflow.llm.mixing import mix_documents
from tradeflow.llm.packing import pack
from tradeflow.llm.pu_classifier import keep_quality
from tradeflow.llm.quality_rules import quality_rules

# Staged tables of the stages that ran before; a stage's input is written, so they can go.
LEFT: list[str] = []


def stage_of(apply):
    """The stage function ``apply``, which first removes what earlier stages left behind."""

    @functools.wraps(apply)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(LEFT, docs)
        with noting(LEFT):
            return apply(spark, docs, sf_dir)

    return run_stage


@stage_of
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


@stage_of
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = free_name(docs, "__quality")
    return quality_rules(docs, name=verdict).filter(F.col(verdict)["kept"]).drop(verdict)


@stage_of
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by a running number, so that null and repeated ids hide no copies.

    The number is a row's place in the files that ``docs`` is read from, so texts are not copied.
    Rows without words are no near copies of each other; equal ones of one id are one.
    """
    number = free_name(docs, "__row")
    rows = numbered(docs, number)
    narrow = rows.select(F.col(number).alias("row"), "doc_id")
    groups = jaccard_components(rows.select(F.col(number).alias("doc_id"), "text")).filter("n_shingles > 0").select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    # the smallest id stays, a null one only where the group has no other
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    kept = stage(narrow.join(groups, "row").groupBy("group").agg(first.alias("row")).select("row"), "firsts")
    others = stage(narrow.select("row").join(kept, "row", "left_anti"), "others")
    blank = rows.filter(~text_or_empty().rlike("[^ \\t-\\r]")).dropDuplicates(["doc_id", "text"])
    return select_rows(rows, number, kept, others).unionByName(blank).drop(number)


@stage_of
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


@stage_of
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# Tokenizer ids, a fitted model and similarity components are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``: each stage is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
