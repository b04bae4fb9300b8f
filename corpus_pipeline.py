"""A training corpus from raw documents: five stages, each one operator of
``salesq.llm`` over all documents that the stage before kept.

1. toxicity: documents that compression distance scores toxic go.
2. language: documents without a known or with an ambiguous language go.
3. near_duplicates: one document of each SimHash group stays.
4. mixing: documents appear as often as the mix to target weights takes them.
5. tokens: SentencePiece ids of each document, checked by decoding.

NULL or empty texts pass the first stage like any text without windows and go in
the second; an empty table runs through; extra columns of ``documents`` are kept
by all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesq.llm import language_id, mixing, sentencepieces, simhash, token_counts, toxicity
from salesq.llm.common import shared_path, ship
from salesq.session import read_table, scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.accepted(docs, read_table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_id.accepted(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ship(spark)
    return sentencepieces.encode(docs, public_tokenizers.path(token_counts.MODEL))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# Learned models, components and dependent rounding are beyond SQL; the tests hold
# the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every earlier one is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        with scratch(spark):  # a stage's own intermediate tables go when its result is written
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
