"""A training corpus from ``documents``: five stages, each an operator of
``cadence.llm`` over all rows that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``.

1. toxicity: documents predicted toxic go.
2. quality rules: documents that the rules reject go.
3. n-gram Jaccard join: one document of each class of near duplicates stays.
4. substring dedup: words covered by repeated 35-word windows go; the words left
   are joined by one space. ``n_chars`` follows the text. A document that loses
   all words stays, with an empty text.
5. packing: the pieces of all documents and their places in sequences.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import jaccard_forest, packing, quality, substring, toxicity
from cadence.llm.common import importable, table, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return jaccard_forest.one_of_each(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    kept = substring.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return kept
    chars = F.when(F.col("n_chars").isNotNull(), F.char_length(F.coalesce("text", F.lit(""))))
    return kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.packed(docs, os.fspath(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("jaccard_forest", drop_near_duplicates),
    ("substring_dedup", drop_repeated_spans),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL; the tests hold run() against a
#: plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
